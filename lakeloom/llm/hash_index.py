"""Exact deduplication through an extendible-hash index on shared files. DataFrame functions only."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.base import text_or_empty
from lakeloom.plans import durable

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOOK = 3  # leading bits beyond the directory's that one round of doubling counts
MOST_BITS = 20  # a directory has 2**20 slots at most, which bounds what is broadcast; buckets beyond that grow instead
HEADS = 10_000  # a hash is hot if it has over 1/HEADS of the rows, so there are at most HEADS hot ones


def slot(h: str, bits: int) -> Column:
    """The leading ``bits`` of a 64-bit hash."""
    return F.shiftrightunsigned(h, 64 - bits) if bits else F.lit(0).cast("long")


class HashIndex:
    """One entry (h, text, n, last) per distinct text: its hash, the rows that have it and the largest of their numbers.

    The directory has 2**depth slots, named by the leading bits of a hash; each points to a bucket, and a bucket that has fewer bits serves
    all slots that begin with them. A bucket is a folder of files sorted by hash. One that holds more than ``capacity`` hashes is split by its
    next bit, and where it has all of the directory's bits the directory doubles. Buckets are ranges of the hash, each written by the one
    task that owns it; entries of one hash stand next to each other there and are told apart by their bytes. Only buckets that a batch
    reaches are read and written again.
    """

    SCHEMA = "h long, text string, n long, last long"

    def __init__(self, spark: SparkSession, capacity: int = 32_768):
        self.spark, self.capacity = spark, capacity
        self.root, self.version = durable.scratch_dir(spark, "index"), 0
        self.buckets: dict[str, str | None] = {"": None}  # leading bits -> folder

    @property
    def depth(self) -> int:
        return max(map(len, self.buckets))

    def directory(self) -> list[tuple[int, str]]:
        """(slot, bucket) of all 2**depth slots."""
        out = []
        for bits in self.buckets:
            free = self.depth - len(bits)
            first = int(bits or "0", 2) << free
            out += [(first + i, bits) for i in range(1 << free)]
        return sorted(out)

    def table(self, buckets: list[str] | None = None) -> DataFrame:
        """All entries, or those of some buckets."""
        names = list(self.buckets) if buckets is None else buckets
        paths = [self.buckets[b] for b in names if self.buckets[b]]
        reader = self.spark.read.schema(self.SCHEMA)
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], self.SCHEMA)

    def add(self, rows: DataFrame, heads: DataFrame) -> None:
        """``rows``: (h, text, last); ``heads``: (h, n) of the same rows, one per hash, written before."""
        total, before = heads.agg(F.sum("n")).first()[0] or 0, dict(self.buckets)
        if not total:
            return
        reached = self._grow(heads.select("h"))
        stale = [b for b in before if before[b] and any(r.startswith(b) for r in reached)]
        known = self.spark.read.schema(self.SCHEMA).parquet(*[before[b] for b in stale]) if stale else None
        bits = self.depth
        slots = F.broadcast(self.spark.createDataFrame(self.directory(), "slot long, bucket string"))
        routed = rows.withColumn("n", F.lit(1).cast("long")).select("h", "text", "n", "last")
        hot = F.broadcast(heads.filter(F.col("n") * HEADS > total).select("h"))
        often, rest = routed.join(hot, "h", "left_semi"), routed.join(hot, "h", "left_anti")
        # hot texts are counted before they are sent; what one owner gets of them is a row per text
        often = often.groupBy("h", "text").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
        for more in (often, known):
            rest = rest if more is None else rest.unionByName(more)
        owned = rest.withColumn("slot", slot("h", bits)).join(slots, "slot").drop("slot").repartition("bucket")
        entries = owned.groupBy("bucket", "h", "text").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
        path, self.version = f"{self.root}/v{self.version}", self.version + 1
        entries.withColumn("bucket", F.concat(F.lit("b"), "bucket")).sortWithinPartitions("bucket", "h").write.partitionBy("bucket").parquet(path)
        for b in self.buckets:
            if b in reached:
                self.buckets[b] = f"{path}/bucket=b{b}"
        for b in stale:
            durable.discard(self.spark, before[b])

    def _bucket(self, bits: str) -> str:
        return next(bits[:d] for d in range(len(bits) + 1) if bits[:d] in self.buckets)

    def _grow(self, fresh: DataFrame) -> set[str]:
        """Split buckets until none holds more than its capacity with the ``fresh`` hashes; returns the buckets that are to be written."""
        keys, split = fresh, set()
        if any(self.buckets.values()):
            keys = self.table().select("h").unionByName(fresh).distinct()
        while True:
            bits = min(self.depth + LOOK, MOST_BITS)
            count = _by_slot(keys, bits)
            while True:
                held: Counter[str] = Counter()
                for name, n in count.items():
                    held[self._bucket(name)] += n
                full = [b for b, n in held.items() if n > self.capacity and len(b) < bits]
                if not full:
                    break
                for b in full:
                    old = self.buckets.pop(b)
                    self.buckets |= {b + "0": old, b + "1": old}
                    split |= {b + "0", b + "1"}
            if bits == MOST_BITS or max(held.values()) <= self.capacity:
                break
        for b in set(self.buckets) - set(held):
            self.buckets[b] = None
        return (split & set(held)) | {self._bucket(name) for name in _by_slot(fresh, bits)}


def _by_slot(keys: DataFrame, bits: int) -> dict[str, int]:
    """Hashes per leading bits; at most 2**LOOK counts for each slot of the directory come to the driver."""
    return {f"{r.slot:0{bits}b}": r.n for r in keys.groupBy(slot("h", bits).alias("slot")).agg(F.count("*").alias("n")).collect()}


def exact_duplicates(docs: DataFrame, capacity: int = 32_768, key: Column | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row of ``docs``.

    Texts are equal if they are the same bytes after A-Z are lower-cased. Of equal texts the row with the largest doc_id stays. Hashes of all
    rows are counted first (a few bytes a row); the texts then go once to the owners of the hash ranges, which compare them byte by byte
    and write the index. A row finds its entry by its hash, which names one text unless several share it; those are told
    apart by their SHA-256. Rows of hot hashes meet their entries, at most HEADS, without being moved.

    Null texts count as empty, and empty texts are equal. A null doc_id is smaller than any other; of rows that share the largest one, exactly one
    stays. An empty table gives an empty result. Other columns are not read. ``key`` is the 64-bit hash of ``text`` (xxhash64, if null).
    """
    spark = docs.sparkSession
    text = F.translate(text_or_empty(), UPPER, LOWER)
    texts = docs.select(F.col("doc_id").cast("long").alias("last"), text.alias("text"))
    texts = texts.withColumn("h", F.xxhash64("text") if key is None else key)
    rows = durable.cut(texts.select(
        F.monotonically_increasing_id().alias("row"), F.col("last").alias("doc_id"), "h", F.sha2(F.col("text"), 256).alias("text_sha256")), "rows")
    newest = F.max(F.struct("doc_id", "row"))["row"].alias("keep_row")
    heads = durable.cut(rows.groupBy("h").agg(F.count("*").alias("n"), newest), "heads")
    index = HashIndex(spark, capacity)
    index.add(texts, heads.select("h", "n"))
    owners = durable.cut(_owners(index.table(), rows, heads, newest), "owners")
    durable.discard(spark, index.root)
    total = heads.agg(F.sum("n").alias("n"))
    hot = F.broadcast(owners.filter(F.col("group_size") * HEADS > total.scalar()))
    cold = owners.filter(F.col("group_size") * HEADS <= total.scalar())
    mine = F.expr("o.sha IS NULL OR o.sha = r.text_sha256") & (F.col("r.h") == F.col("o.h"))
    out = ["doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256"]
    often = rows.alias("r").join(hot.alias("o"), mine).select(*out)
    return often.unionByName(rows.alias("r").join(hot.alias("o"), mine, "left_anti").alias("r").join(cold.alias("o"), mine).select(*out))


def _owners(entries: DataFrame, rows: DataFrame, heads: DataFrame, newest: Column) -> DataFrame:
    """(h, sha, keep_id, group_size, keep_row) of each entry; ``sha`` is null where the hash has one text."""
    chains = entries.groupBy("h").agg(F.count("*").alias("texts"), F.max("last").alias("keep_id"), F.max("n").alias("group_size"))
    single = chains.filter("texts = 1").join(heads, "h").select(
        "h", F.lit(None).cast("string").alias("sha"), "keep_id", "group_size", "keep_row")
    shared = chains.filter("texts > 1").select("h")
    if shared.isEmpty():
        return single
    found = entries.join(shared, "h").select("h", F.sha2(F.col("text"), 256).alias("sha"), F.col("last").alias("keep_id"), F.col("n").alias("group_size"))
    last = rows.join(shared, "h").groupBy("h", F.col("text_sha256").alias("sha")).agg(newest)
    return single.unionByName(found.join(last, ["h", "sha"]))
