"""Shared pieces of the text operators: words, lineage cuts, size-checked broadcasts, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Space, tab, line feed, vertical tab, form feed and carriage return: what separates words.
WHITE_SPACE = " \t\n\x0b\x0c\r"
#: The same set as a character class, for Java's and DuckDB's regular expressions.
WHITE_CLASS = r"[\x20\x09-\x0D]"
#: Largest index or side table, in bytes, that is sent to every executor.
MAX_BROADCAST_BYTES = 64 << 20


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it; a temporary one only in local mode, where there is one machine."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Writes df to the shared checkpoint folder and reads it back: later jobs don't redo its work, and losing an executor loses nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """df as a compressed table in the shared folder, read back: a checkpoint for long, narrow rows, which take half the room so."""
    folder = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4()}"
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.parquet(folder)


#: Bits of the largest bitmap of keys (16 MiB), and bits for each key.
KEY_BITS, BITS_EACH = 1 << 27, 16


class KeyBits:
    """A bitmap of 64-bit hashes: all that were put in are found, and some others, more of them when it is full."""

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, len(words) * 64 - 1

    @classmethod
    def of(cls, keys: DataFrame, name: str) -> KeyBits:
        """Of the hashes in a column. Its size is bounded, whatever the number of keys; it is gathered as its 64-bit words."""
        bits = 1 << min(KEY_BITS.bit_length() - 1, max(12, (keys.count() * BITS_EACH).bit_length()))
        slot = F.col(name).bitwiseAND(F.lit(bits - 1))
        got = keys.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.expr(f"bit_or(shiftleft(1L, cast(`{name}` & 63 as int)))").alias("bits")).toArrow()
        words = np.zeros(bits >> 6, np.int64)
        words[got.column("word").to_numpy()] = got.column("bits").to_numpy()
        return cls(words)

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = keys & self.mask
        return (self.words[at >> 6] >> (at & 63)) & 1 == 1


def only(df: DataFrame, keys: KeyBits, name: str, there: bool = True) -> DataFrame:
    """The rows of df whose hash the bitmap has (or has not), so that the others need not travel to a join that has nothing for them."""
    sent = df.sparkSession.sparkContext.broadcast(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(sent.value.has(b.column(name).to_numpy(zero_copy_only=False)) == there))

    return df.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in df.dtypes))


def same(a: Column, b: Column) -> Column:
    """Equality under which null equals null."""
    return a.eqNullSafe(b)


def unused(name: str, df: DataFrame) -> str:
    """name, or name with underscores behind it, so that no column of df is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words_of(text: str | None) -> list[bytes]:
    """UTF-8 words of a text. bytes.split() separates at exactly the six characters of WHITE_SPACE."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lowered_words_of(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased; bytes.lower() leaves every other byte as it is."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


#: Edges of one partition while components are found.
EDGES = 500_000


def _mark(edges: DataFrame) -> tuple[int, int]:
    """How many distinct edges there are, and the exclusive or of their hashes: equal for equal sets of edges."""
    return tuple(edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("v", "m")), F.lit(0))).first())


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges(a, b) as (id, component), component being the smallest id reachable.

    Large-star and small-star rounds over the edges until nothing changes, which
    ends, as each change makes a number smaller. Every
    round is a distributed join and aggregation; only a changed-or-not flag
    reaches the driver. The minimum of a node's neighbours is an aggregate, so a
    node of very many edges is not gathered in one task.
    """
    now = cut(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).filter("v <> m").distinct())
    n, mark = _mark(now)
    # Edges are few bytes: as many partitions as they need, whatever the session's number is.
    parts = max(1, -(-n // EDGES))
    while True:
        now = now.coalesce(parts)
        both = now.unionByName(now.select(F.col("m").alias("v"), F.col("v").alias("m")))
        low = both.groupBy("v").agg(F.min("m").alias("low")).select("v", F.least("v", "low").alias("low")).coalesce(parts)
        large = both.join(low, "v").filter("m > v").select(F.col("m").alias("v"), F.col("low").alias("m")).filter("v <> m")
        large = large.coalesce(parts).distinct().coalesce(parts)
        low = large.groupBy("v").agg(F.min("m").alias("low")).coalesce(parts)
        to_low = large.join(low, "v").select(F.col("m").alias("v"), F.col("low").alias("m")).filter("v <> m")
        now = cut(to_low.unionByName(low.withColumnRenamed("low", "m")).coalesce(parts).distinct().coalesce(parts))
        before, (n, mark) = (n, mark), _mark(now)
        if before == (n, mark):
            break
    roots = now.select(F.col("m").alias("id")).distinct()
    return now.groupBy(F.col("v").alias("id")).agg(F.min("m").alias("component")).unionByName(
        roots.join(now.select(F.col("v").alias("id")), "id", "left_anti").select("id", F.col("id").alias("component"))
    )


#: Members of a node that meet in one block of a comparison.
BLOCK = 4096


def open_nodes(rows: DataFrame, group: DataFrame | None = None, wide: DataFrame | None = None) -> DataFrame:
    """The rows(node, id, ...) of nodes that hold more than one component, with the node's largest (major), how many members it has and how many are outside that (minor).

    group(id, component) are the components so far, where rows don't have them; wide has further columns by id.
    """
    if group is not None:
        rows = rows.join(group, "id", "left").withColumn("component", F.coalesce("component", "id"))
    each = rows.groupBy("node", "component").agg(F.count("*").alias("k"))
    state = each.groupBy("node").agg(F.max(F.struct("k", "component")).alias("top"), F.sum("k").alias("members"))
    state = state.select("node", F.col("top.component").alias("major"), "members", (F.col("members") - F.col("top.k")).alias("minor")).filter("minor > 0")
    rows = rows.join(state, "node")
    return cut(rows if wide is None else rows.join(wide, "id"))


def meet(left: DataFrame, right: DataFrame, near: Column, many: str | None = None) -> DataFrame:
    """Pairs (hub, spoke) of a row x of left and a row y of right in the same node, of different components, that near lets pass.

    Both sides of a large node are dealt into blocks, each block of one side meeting each of the other in a group of its own.
    many is the column that bounds how many of a node's rows are in left; without it they are few.
    """
    blocks = [F.lit(1) if c is None else F.ceil(F.col(c) / BLOCK) for c in (many, "members")]
    own = [F.pmod(F.xxhash64(F.lit("block"), "id"), n).cast("int") for n in blocks]
    others = [F.explode(F.sequence(F.lit(0), (n - 1).cast("int"))) for n in blocks]
    x = left.withColumn("i", own[0]).withColumn("j", others[1]).alias("x")
    y = right.withColumn("j", own[1]).withColumn("i", others[0]).alias("y")
    same_place = (F.col("x.node") == F.col("y.node")) & (F.col("x.i") == F.col("y.i")) & (F.col("x.j") == F.col("y.j"))
    met = x.join(y, same_place & (F.col("x.component") != F.col("y.component")) & near)
    return met.select(F.col("x.id").alias("hub"), F.col("y.id").alias("spoke"))
