"""What the operators share: reading tables, stored intermediate results, identities of rows."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from functools import reduce
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemart.session import work_dir
from lakemart.sources.files import delete

#: A word is a run of characters other than these.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the folder all executors share, and read it back.

    It cuts the lineage: an executor lost later costs a read, not the work
    before. Everything of one application is below one folder, which may be
    removed when the application has ended.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/llm-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a ``stored`` result that nothing will read again."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        delete(df.sparkSession, path)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or a longer name that no column of ``df`` has (Spark compares without case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def with_row_key(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a column that tells any two rows apart, repeated rows too.

    For a table read from files it is the file and the place in it, the same in
    every evaluation. Any other DataFrame is stored first, for the same reason.
    """
    try:
        meta = df.metadataColumn("_metadata")
        return df.select("*", F.struct(meta["file_path"], meta["row_index"]).alias(name))
    except AnalysisException:
        return with_row_key(stored(df, "rows"), name)


def apart(key: str) -> Column:
    """A whole number's complement, to join a counted side by that would stay where it was counted.

    Joined by the key itself, Spark would bring the other side there: all rows
    of a frequent key to one task, which can't be split then. By the complement
    the counted side, a row per key, is dealt out anew, and AQE may split the other.
    """
    return F.bitwise_not(F.col(key))


def n_words(text: Column) -> Column:
    """Number of words of a text; none for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def places(rows: DataFrame, group: str, part: str, order: list[str], same: str, name: str, heavy: int = 50_000) -> DataFrame:
    """Number the rows of every ``group`` 0, 1, 2, … by (``part``, ``order``), however large a group is.

    A group is dealt into its ``part``s, which are counted first; the number of
    a row is its place in its part plus the rows of the parts before. ``part``
    should be a function of ``same``, or finer than groups allow; rows that
    share one value of ``same`` more than ``heavy`` times (repeated rows, a
    NULL id) are dealt into 256 parts by their place in the stored table. What
    is moved is counted or sorted in parts, never a whole group.
    ``rows`` must be narrow; they are stored, as several steps read them.
    """
    kept = rows.columns
    rows = stored(rows.withColumn("_salt", F.monotonically_increasing_id()), "places")
    dealt = rows.join(_often(rows, same, heavy), F.col(same) == F.col("_often"), "left").withColumn(
        "_deal", F.when(F.col("_often").isNotNull(), F.col("_salt") % 256).otherwise(0)
    )
    counts = dealt.groupBy(F.col(group).alias("_group"), F.col(part).alias("_of_part"), F.col("_deal").alias("_of_deal")).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_group").orderBy("_of_part", "_of_deal").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    inside = Window.partitionBy(group, part, "_deal").orderBy(*order, "_salt")
    placed = dealt.withColumn("_place", F.row_number().over(inside) - 1)
    matches = F.col(group).eqNullSafe(F.col("_group")) & (F.col(part) == F.col("_of_part")) & (F.col("_deal") == F.col("_of_deal"))
    return placed.join(starts, matches).select(*kept, (F.col("_start") + F.col("_place")).cast("long").alias(name))


def _often(rows: DataFrame, same: str, heavy: int) -> DataFrame:
    return rows.groupBy(F.col(same).alias("_often")).agg(F.count("*").alias("_n")).filter(F.col("_n") > heavy).select("_often")


def _by_weight(units: DataFrame, group: str, part: str, order: list[str], name: str) -> DataFrame:
    """``units`` with the sum of the weights before them in their group, by (``part``, ``order``): a part's, then those in the part."""
    before = Window.partitionBy("_group").orderBy("_of_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = units.groupBy(F.col(group).alias("_group"), F.col(part).alias("_of_part")).agg(F.sum("_weight").alias("_n"))
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    inside = Window.partitionBy(group, part).orderBy(*order, "_salt").rowsBetween(Window.unboundedPreceding, -1)
    placed = units.withColumn("_inner", F.coalesce(F.sum("_weight").over(inside), F.lit(0)))
    matches = F.col(group).eqNullSafe(F.col("_group")) & (F.col(part) == F.col("_of_part"))
    return placed.join(starts, matches).withColumn(name, (F.col("_start") + F.col("_inner")).cast("long"))


def ordered_places(rows: DataFrame, group: str, part: str, order: list[str], same: str, name: str, heavy: int = 50_000) -> DataFrame:
    """``places`` in exactly that order, whatever repeats: only rows equal in ``order`` change places with each other.

    Rows that share a value of ``same`` more than ``heavy`` times stand in the
    order as one entry for each of their values of ``order``, with a weight.
    Behind it they are equal, so they are counted off in 256 parts. So the
    places don't depend on ``heavy`` or on the files; it only says how the work
    is cut. ``order`` may take few values where ``same`` is given.
    """
    kept = rows.columns
    rows = stored(rows.withColumn("_salt", F.monotonically_increasing_id()), "places").withColumn("_weight", F.lit(1).cast("long"))
    often = stored(_often(rows, same, heavy), "often")
    if often.isEmpty():
        return _by_weight(rows, group, part, order, name).select(*kept, name)
    marked = rows.join(often, F.col(same) == F.col("_often"), "left")
    crowd = marked.filter("_often IS NOT NULL").withColumn("_deal", F.col("_salt") % 256)
    key = [group, part, *order]
    dealt = crowd.groupBy(*key, "_deal").agg(F.count("*").alias("_weight"))
    entries = dealt.groupBy(*key).agg(F.sum("_weight").alias("_weight")).withColumn("_salt", F.lit(-1).cast("long"))
    light = marked.filter("_often IS NULL").drop("_often")
    units = _by_weight(light.unionByName(entries, allowMissingColumns=True), group, part, order, name)
    # The crowd: the entry's place, the equal rows of the deals before, the place in the deal.
    earlier = Window.partitionBy(*key).orderBy("_deal").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.withColumn("_ahead", F.coalesce(F.sum("_weight").over(earlier), F.lit(0)))
    named = {c: f"_of_{i}" for i, c in enumerate([*key, "_deal"])}

    def equal(columns: list[str]) -> Column:
        return reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(named[c])) for c in columns))

    at = units.filter("_salt = -1").select(*key, name).withColumnsRenamed({c: named[c] for c in key})
    offsets = offsets.join(at, equal(key)).select(*(F.col(c).alias(f"_by_{i}") for i, c in enumerate([*key, "_deal"])), (F.col(name) + F.col("_ahead")).alias("_first"))
    same_deal = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_by_{i}")) for i, c in enumerate([*key, "_deal"])))
    nth = F.row_number().over(Window.partitionBy(*key, "_deal").orderBy("_salt")) - 1
    counted = crowd.withColumn("_nth", nth).join(offsets, same_deal)
    return units.filter("_salt >= 0").select(*kept, name).unionByName(
        counted.select(*kept, (F.col("_first") + F.col("_nth")).cast("long").alias(name))
    )


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of ``spark``, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="lakemart-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, str(source.relative_to(package.parent)))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


_shipped: set[str] = set()
