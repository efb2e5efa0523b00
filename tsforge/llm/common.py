"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tsforge.session import ensure_checkpoint_dir

#: A word is a run of characters other than the blank and TAB..CR.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` evaluated once.  A projection that Catalyst
    collapses would put the whole expression inside every lambda that reads
    it; a lambda variable can't be inlined."""
    return F.element_at(F.transform(F.array(value), lambda x: body(x)), 1)


def words(text: Column) -> Column:
    """The words of a text, in order (null: no words)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), lambda w: w != "")


def text_key(text: Column) -> Column:
    """16 bytes that stand for a text (null counts as empty)."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def id_mod(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null id: of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def fresh(cols: list[str], *names: str) -> list[str]:
    """Working column names that clash with none of ``cols``."""
    taken, out = {c.lower() for c in cols}, []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage, survives
    lost executors, is read column by column."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """:func:`written` with the rows of a key in one of as many buckets as a shuffle has
    partitions: grouping by the key reads a bucket a task and doesn't shuffle the table again."""
    spark = df.sparkSession
    at = f"{name}-{uuid.uuid4().hex}"
    called = f"spark_catalog.default.{at.replace('-', '_')}"
    buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 100_000)  # as many as Spark allows
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{at}"
    df.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(called)
    out = spark.table(called)
    spark.sql(f"DROP TABLE {called}")  # the name alone: files at a given path stay
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables of :func:`written` that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        root = ensure_checkpoint_dir(spark).rstrip("/")
        for at in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if at.startswith(root) or at.split(":", 1)[-1].lstrip("/").startswith(root.split(":", 1)[-1].lstrip("/")):
                path = spark._jvm.org.apache.hadoop.fs.Path(at)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Rows up to which :func:`small_side` broadcasts (keys of some tens of bytes).
BROADCAST_ROWS = 1_000_000


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows; a larger one
    is left to the planner's shuffled join.  Give it written tables: it counts."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def slices(batches, rows: int = 500):
    """Arrow batches of at most ``rows`` rows: long texts become Python strings a few at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
