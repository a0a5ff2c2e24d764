"""Sources mixed to target weights: packed blocks, multinomial draws per shard, index permutations.

DataFrame expressions only. Words are runs of anything but ASCII white space.

1. A source's documents are laid end to end and cut into blocks of `block` words, the last one shorter.
2. Targets: the wanted total, shared by weight; a target stops at `cap` times its source's size and what is over goes
   to the others by weight. A source's quota is its target in blocks of its mean length.
3. The output has one slot for each block of all quotas, `shard` slots to a shard. A slot draws its source by the
   quotas, so a shard's source counts are multinomial. Draws beyond a source's quota go to the sources that lack some.
4. The k-th slot of a source takes block permutation(k mod blocks) of its epoch k div blocks, so every block is used
   once before any is used again, and none more often than the cap allows.
5. Slots and blocks meet on (source, block).

Running totals are taken in two levels of about the square root of the rows each, so no source or shard has to fit into one task.
Draws and permutations are hashes of their place and the seed: a rerun gives the same mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: Values of a page of the tables in which a number is looked up by the interval that holds it.
PAGE = 4096
ROUNDS = 16


def _draw(seed: int, *what) -> Column:
    return F.xxhash64(F.lit(seed), *what)


def permuted(x: Column, n: Column, seed: int, *key) -> Column:
    """Image of x under a pseudorandom permutation of 0 .. n-1 (swap-or-not shuffle of Hoang and others, 2012)."""

    def swap(at: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(_draw(seed, F.lit("pivot"), r, *key), n) - at, n)
        return F.when(_draw(seed, F.lit("swap"), r, F.greatest(at, other), *key) % 2 == 0, other).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x.cast("long"), swap)


def running_total(rows: DataFrame, by: list[str], chunk: str, order: list[str], value: str, out: str) -> DataFrame:
    """Total of `value` over all earlier rows with equal `by`, in the order of (chunk, *order)."""
    key = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_{c}") for c in by] + [F.col(c).isNull().alias(f"_no_{c}") for c in by]
    rows = rows.select("*", *key)
    names = [f"_{c}" for c in by] + [f"_no_{c}" for c in by]
    sums = rows.groupBy(*names, chunk).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*names).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    inner = Window.partitionBy(*names, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("_own", F.coalesce(F.sum(value).over(inner), F.lit(0)))
        .join(sums, [*names, chunk])
        .withColumn(out, F.col("_base") + F.col("_own"))
        .drop("_base", "_own", *names)
    )


def looked_up(rows: DataFrame, at: str, intervals: DataFrame) -> DataFrame:
    """Each row with the interval (lo <= at < hi) that holds it, met page by page."""
    pages = intervals.where("hi > lo").select("*", F.explode(F.sequence(F.expr(f"lo div {PAGE}"), F.expr(f"(hi - 1) div {PAGE}"))).alias("_page"))
    rows = rows.withColumn("_page", F.expr(f"{at} div {PAGE}"))
    return rows.join(pages, "_page").where(f"{at} >= lo and {at} < hi").drop("_page")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], ratio: float, cap: float) -> DataFrame:
    """(source, sid, source_size, target): one row for each source, so windows over all of them are short."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = sources.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    sources = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("sid") % len(weights) + 1).cast("double"))
    sources = sources.withColumn("most", F.col("source_size") * F.lit(float(cap)))
    every = Window.partitionBy(F.lit(0))
    full = Window.partitionBy(F.lit(0)).orderBy(F.col("most") / F.col("weight"), "sid")
    earlier = full.rowsBetween(Window.unboundedPreceding, -1)
    sources = sources.withColumn("wanted", F.sum("source_size").over(every) * F.lit(float(ratio)))
    # In order of the level at which they stop: as long as a source stops below the level, it takes its cap.
    sources = sources.withColumn(
        "level",
        (F.col("wanted") - F.coalesce(F.sum("most").over(earlier), F.lit(0.0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))),
    )
    sources = sources.withColumn("stops", F.col("most") <= F.col("level") * F.col("weight")).withColumn("place", F.row_number().over(full))
    sources = sources.withColumn("level", F.min_by(F.when(~F.col("stops"), F.col("level")), F.when(~F.col("stops"), F.col("place"))).over(every))
    target = F.coalesce(F.least("most", F.col("level") * F.col("weight")), F.col("most"))
    return sources.select("source", "sid", "source_size", target.alias("target"))


class Mix:
    """Tables of one mix, each written to the shared folder.

    documents  (doc_id, source, sid, size, start, source_size, target): `start` is a document's first word in its source
    slots      (slot, shard, sid, epoch, block)
    """

    def __init__(self, documents: DataFrame, slots: DataFrame, block: int):
        self.documents, self.slots, self.block = documents, slots, block

    def spans(self) -> DataFrame:
        """(sid, start, doc_id, epoch, block, from, to): the words of each document that a slot takes, counted from 0."""
        n = self.block
        docs = self.documents.where("size > 0").select(
            "sid", "start", "doc_id", "size", F.explode(F.expr(f"sequence(start div {n}, (start + size - 1) div {n})")).alias("block")
        )
        return docs.join(self.slots.select("sid", "block", "epoch", "slot", "shard"), ["sid", "block"]).select(
            "sid", "start", "doc_id", "epoch", "block", "slot", "shard",
            F.expr(f"greatest(block * {n} - start, 0)").alias("from"),
            F.expr(f"least((block + 1) * {n} - start, size)").alias("to"),
        )

    def taken(self) -> DataFrame:
        """(doc_id, size, source_size, target, taken, source): every document, with the words that the mix takes from it."""
        words = self.spans().groupBy("sid", "start").agg(F.sum(F.col("to") - F.col("from")).alias("taken"))
        words = words.withColumn("some", F.lit(True))
        docs = self.documents.withColumn("some", F.col("size") > 0)
        return docs.join(words, ["sid", "start", "some"], "left").select(
            "doc_id", F.col("size").cast("long"), F.col("source_size").cast("long"), F.col("target").cast("double"), F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "source"
        )


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    ratio: float = 1.5,
    cap: float = 2.0,
    block: int = 128,
    shard: int = 1024,
    seed: int = 17,
    row_col: str | None = None,
) -> Mix:
    """Mix all documents; `weights` repeat over the sources in code point order, null last.

    A null or empty text has no words, and a null source is a source of its own. A null id sorts first; repeated ids are
    documents of their own. An empty table, or one without words, gives no slots. Only the named columns are read.
    `row_col` names a column that numbers the rows; it then stands in the tables for the id, and has no say in the order.
    """
    spark = docs.sparkSession
    words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    # Rows that share an id are told apart by their text.
    numbered = [F.xxhash64(text_col).alias("digest"), F.col(row_col).alias("row")] if row_col else []
    apart = ["digest"] if row_col else []
    sizes = materialize(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words.alias("size"), *numbered), "sizes")
    sources = source_targets(sizes, weights, ratio, cap)
    sources = sources.withColumn("blocks", F.ceil(F.col("source_size") / block)).withColumn(
        "quota", F.when(F.col("blocks") > 0, F.least(F.round(F.col("target") * F.col("blocks") / F.col("source_size")), F.floor(F.col("blocks") * F.lit(float(cap))))).otherwise(0).cast("long")
    )
    ahead = Window.partitionBy(F.lit(0)).orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    sources = materialize(sources.withColumn("lo", F.coalesce(F.sum("quota").over(ahead), F.lit(0)).cast("long")).withColumn("hi", F.col("lo") + F.col("quota")), "sources")
    # Where each document starts in its source.
    chunks = max(1, int(sizes.count() ** 0.5))
    placed = sizes.withColumn("chunk", F.pmod(_draw(seed, F.lit("chunk"), "doc_id", *apart), F.lit(chunks)))
    placed = running_total(placed, ["source"], "chunk", ["doc_id", "size", *apart], "size", "start")
    if row_col:
        placed = placed.withColumn("doc_id", F.col("row")).drop("row", "digest")
    named = sources.select(F.col("source").alias("_s"), "sid", "source_size", "target")
    placed = materialize(placed.join(named, F.col("source").eqNullSafe(F.col("_s"))).drop("_s", "chunk"), "placed")
    # A source for each slot.
    total = int(sources.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0])
    slots = spark.range(total).select(F.col("id").alias("slot"), F.expr(f"id div {shard}").alias("shard"))
    drawn = slots.withColumn("u", F.pmod(_draw(seed, F.lit("slot"), "slot"), F.lit(max(1, total))))
    drawn = looked_up(drawn, "u", sources.select("sid", "quota", "lo", "hi")).select("slot", "shard", "sid", "quota")
    far = F.expr(f"shard div {max(1, int((total / shard) ** 0.5))}")
    counts = drawn.groupBy("sid", "quota", "shard").agg(F.count("*").alias("n")).withColumn("far", far)
    counts = running_total(counts, ["sid"], "far", ["shard"], "n", "base")
    counts = materialize(counts.select("sid", "quota", "shard", "n", "base"), "counts")
    inner = Window.partitionBy("sid", "shard").orderBy("slot")
    ranked = drawn.join(counts.select("sid", "shard", "base"), ["sid", "shard"]).withColumn("k", F.col("base") + F.row_number().over(inner) - 1)
    ranked = materialize(ranked.select("slot", "shard", "sid", "quota", "k"), "ranked")
    kept = ranked.where("k < quota").select("slot", "shard", "sid", "k")
    # Slots drawn beyond a quota, in order of their number, go to the sources that lack some.
    over = ranked.where("k >= quota").select("slot", "shard", far.alias("far"), F.lit(1).alias("one"), F.lit(0).alias("all"))
    over = running_total(over, ["all"], "far", ["slot"], "one", "r").select("slot", "shard", "r")
    have = counts.groupBy("sid").agg(F.sum("n").alias("n"))
    lack = sources.join(have, "sid", "left").select("sid", F.coalesce("n", F.lit(0)).alias("had"), F.greatest(F.col("quota") - F.coalesce("n", F.lit(0)), F.lit(0)).alias("lack"))
    lack = lack.withColumn("lo", F.coalesce(F.sum("lack").over(ahead), F.lit(0)).cast("long")).withColumn("hi", F.col("lo") + F.col("lack"))
    moved = looked_up(over, "r", lack).select("slot", "shard", "sid", (F.col("had") + F.col("r") - F.col("lo")).alias("k"))
    every = kept.unionByName(moved).join(sources.select("sid", "blocks"), "sid")
    every = every.withColumn("epoch", F.expr("k div blocks"))
    slots = every.select("slot", "shard", "sid", "epoch", permuted(F.expr("k % blocks"), F.col("blocks"), seed, F.col("sid"), F.col("epoch")).alias("block"))
    return Mix(placed, materialize(slots, "slots"), block)


def mixed_documents(docs: DataFrame, mix: Mix, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents of `docs` as the mix takes them: a row for each document and epoch, its text cut down to the words taken.

    Words keep the white space after them; a document taken whole keeps its text as it is. Documents without a word taken
    are left out. Rows with a repeated or null id have no single place in the mix and are left out as well.
    """
    once = mix.documents.groupBy("doc_id").agg(F.count("*").alias("rows"), F.max("size").alias("size")).where("rows = 1 and doc_id is not null")
    spans = mix.spans().groupBy("doc_id", "epoch").agg(
        F.array_sort(F.collect_list(F.struct("from", "to"))).alias("spans"), F.sum(F.col("to") - F.col("from")).alias("words")
    )
    chosen = spans.join(once, "doc_id").withColumn("partly", F.col("words") < F.col("size")).select("doc_id", "spans", "partly")
    # The other columns travel in a struct, whatever their names.
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.struct(*[F.col(f"`{c}`") for c in others]).alias("others")).join(chosen, "doc_id")
    # Word by word only where a document is taken in part.
    rows = rows.withColumn("pieces", F.when(F.col("partly"), F.regexp_extract_all("text", F.lit(f"{WORD}[\\x20\\x09-\\x0D]*"), F.lit(0))))
    part = F.array_join(F.flatten(F.transform("spans", lambda s: F.slice("pieces", (s["from"] + 1).cast("int"), (s["to"] - s["from"]).cast("int")))), "")
    text = F.when(F.col("partly"), part).otherwise(F.col("text")).alias(text_col)
    return rows.select(*[text if c == text_col else F.col("others")[c].alias(c) for c in docs.columns])


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """`docs` as its mix takes it, like `mixed_documents`, but every row by itself: repeated and null ids come out as well.

    The rows are stored with a number each, by which they meet their places.
    """
    row = "_row"
    while row in (c.lower() for c in docs.columns):
        row = f"_{row}"
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    return mixed_documents(numbered, mix_sources(numbered, id_col, text_col, source_col, row_col=row), row, text_col).drop(row)
