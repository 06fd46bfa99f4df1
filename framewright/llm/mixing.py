"""Sources mixed to target weights by hash thresholds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewright.llm.tokens import RANKS, sized, source_name
from framewright.session import checkpointed, guarded_join

BITS, STEP = 60, 12


def source_texts(documents: DataFrame, path: str = RANKS) -> DataFrame:
    """One row per source and exact text: ``source, doc_id`` (the least), ``n_tokens, h`` (a hash of BITS bits).

    A text listed again under the same source is the same text, so no text is used more often than its source allows. Texts of no
    token and rows without source are left out.
    """
    d = sized(documents, path).where("n_tokens > 0 and source is not null")
    one = d.groupBy("source", "text_key").agg(F.min("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"))
    return one.withColumn("h", F.shiftrightunsigned(F.xxhash64("source", "text_key"), 64 - BITS))


def budgets(texts: DataFrame, targets: DataFrame, total: int | None = None) -> DataFrame:
    """Per source of ``targets``: ``source, target_share, max_repeats, available, budget`` in tokens.

    Without ``total`` the draw is the largest in which every source that has text and may be used keeps its share; a source whose
    ``max_repeats`` is 0, negative or null may not be used, and like one without text it does not hold the others back. With it, a source's budget
    ends at ``max_repeats`` times its text, and its share falls short.
    """
    have = texts.groupBy("source").agg(F.sum("n_tokens").alias("available"))
    t = targets.select(source_name(F.col("source")).alias("source"), F.greatest("target_share", F.lit(0.0)).alias("target_share"), F.greatest(F.coalesce("max_repeats", F.lit(0)), F.lit(0)).alias("max_repeats")).where("source is not null")
    t = t.join(have, "source", "left").withColumn("available", F.coalesce("available", F.lit(0)))
    most = F.col("available") * F.col("max_repeats")
    size = F.lit(float(total)) if total is not None else F.min(F.when((F.col("target_share") > 0) & (most > 0), most / F.col("target_share"))).over(Window.partitionBy(F.lit(0)))
    return t.withColumn("budget", F.least(F.coalesce(F.floor(F.col("target_share") * size + 1e-6), F.lit(0)), most))


def thresholds(texts: DataFrame, budget: DataFrame) -> DataFrame:
    """Per source: whole rounds of its text, and the hash up to which one more copy is drawn (``rounds, upto``).

    Token sums per (source, hash bucket) locate the bucket in which the rest of the budget ends; only that bucket is cut into finer ones,
    by STEP bits a turn, until it holds one hash. The text at the border is drawn if that comes nearer to the budget. Thresholds
    of smaller budgets lie below those of larger ones, so draws are nested.
    """
    live = budget.where("available > 0")
    at = live.select("source", F.floor(F.col("budget") / F.col("available")).alias("rounds"), (F.col("budget") % F.col("available")).alias("rest"), F.lit(0).cast("bigint").alias("prefix"), F.lit(False).alias("end"), F.lit(-1).cast("bigint").alias("upto"))
    at = checkpointed(at)
    rows = texts.select("source", "h", "n_tokens")
    for shift in range(BITS - STEP, -1, -STEP):
        open_ = at.where("not end").select("source", "prefix", "rest")
        rows = guarded_join(rows, open_.select("source", F.col("prefix").alias("__p")), ["source"], "inner").where(F.shiftright("h", shift + STEP) == F.col("__p")).drop("__p")
        if shift < BITS - STEP:
            rows = checkpointed(rows)
        hist = rows.groupBy("source", F.shiftright("h", shift).alias("b")).agg(F.sum("n_tokens").alias("t"), F.when(F.min("h") == F.max("h"), 1).otherwise(2).alias("k"))
        w = Window.partitionBy("source").orderBy("b")
        cum = hist.withColumn("c", F.sum("t").over(w)).join(open_.select("source", "rest"), "source")
        # the first bucket whose running sum passes the rest
        hit = cum.where("c > rest").groupBy("source").agg(F.min_by(F.struct("b", "c", "t", "k"), "b").alias("x"))
        new = at.join(hit, "source", "left")
        before = F.col("x.c") - F.col("x.t")
        border = (F.col("x.k") == 1) | F.lit(shift == 0)
        near = border & (F.col("x.c") - F.col("rest") < F.col("rest") - before)
        top = (F.col("x.b") + F.when(near, 1).otherwise(0)) * F.lit(1 << shift).cast("bigint") - 1
        at = checkpointed(
            new.select(
                "source", "rounds", F.when(F.col("end") | F.col("x").isNull(), F.col("rest")).otherwise(F.col("rest") - before).alias("rest"),
                F.when(F.col("end") | F.col("x").isNull(), F.col("prefix")).otherwise(F.col("x.b")).alias("prefix"),
                (F.col("end") | F.col("x").isNull() | border).alias("end"),
                F.when(F.col("end"), F.col("upto")).when(F.col("x").isNull(), F.lit((1 << BITS) - 1).cast("bigint")).when(border, top).otherwise(F.lit(-1)).alias("upto"),
            )
        )
        if not at.where("not end").limit(1).count():
            break
    return at.select("source", "rounds", "upto")


def mix(documents: DataFrame, targets: DataFrame, total: int | None = None, path: str = RANKS) -> DataFrame:
    """The draw, one row per text drawn: ``doc_id, source, n_tokens, copies``.

    Every source gets ``target_share`` of all tokens to within one text, none of its texts is used more than ``max_repeats`` times. Sources that have
    no text, and documents of sources without target, take no part. The draw needs no sort: a text is in if its hash lies under its
    source's threshold.
    """
    texts = checkpointed(source_texts(documents, path))
    b = checkpointed(budgets(texts, targets, total))
    lim = guarded_join(thresholds(texts, b), b.select("source", "max_repeats"), ["source"])
    out = guarded_join(texts, lim, ["source"], "inner")
    copies = F.least(F.col("rounds") + F.when(F.col("h") <= F.col("upto"), 1).otherwise(0), F.col("max_repeats"))
    return out.select("doc_id", "source", "n_tokens", copies.cast("int").alias("copies")).where("copies > 0")


def shares(drawn: DataFrame, targets: DataFrame) -> DataFrame:
    """Shares really reached per source: ``source, target_share, texts, tokens, most_copies, share, shortfall`` (of the share, at least 0)."""
    got = drawn.groupBy("source").agg(F.count("*").alias("texts"), F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.max("copies").alias("most_copies"))
    t = targets.select(source_name(F.col("source")).alias("source"), "target_share").join(got, "source", "left").na.fill(0, ["texts", "tokens", "most_copies"])
    t = t.withColumn("share", F.round(F.col("tokens") / F.greatest(F.sum("tokens").over(Window.partitionBy(F.lit(0))), F.lit(1)), 6))
    return t.withColumn("shortfall", F.round(F.greatest(F.col("target_share") - F.col("share"), F.lit(0.0)), 6))
