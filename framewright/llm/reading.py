"""Reading level of each document from vocabulary coverage and sentence complexity, calibrated in SQL on rated documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.functions.geometry import let
from framewright.session import checkpointed, guarded_join, written

#: English words that join, subordinate or shift a clause.
CLAUSE_WORDS = "that which who whom whose whereby although though because whereas whether if unless until while as than how why what when so nor not no had been were was be having would could might ought one it".split()
#: Endings of derived words (abstract nouns, adverbs, adjectives, technical verbs).
DERIVED = r"^.{3,}(tion|sion|ment|ity|ness|ance|ence|ism|ology|ic|ical|ous|ive|ly|ised|ized|ates|ating|ated)$"
SHARES = (0.5, 0.8, 0.95)
#: Shares of a text's length from which it is a data object or a log. At sf0.1 all data objects and logs lie above twice these, and prose at 0.
KEYS, ASSIGNMENTS = 0.05, 0.3
FEATURES = ("c50", "c80", "c95", "words_per_sentence", "commas_per_sentence", "clause_share", "word_length", "derived_share", "article_share")
TAG = r"</?[A-Za-z!][^<>]*+>"


def prose_text(text: Column) -> Column:
    """Text without markup, headings, paths, ids and tokens with digits (so without list numbers too); lines stay lines.

    """
    t = F.when(F.contains(text, F.lit("<")), F.regexp_replace(text, TAG, "\n")).otherwise(text)
    t = F.when(F.contains(text, F.lit("#")), F.regexp_replace(t, r"(?m)^[ \t]*+#.*+$", " ")).otherwise(t)
    return let(t, lambda x: F.when(x.rlike(r"[/_\\=\d]"), F.regexp_replace(x, r"([^\s/_\\=\d]++)(?!\S)|\S++", "$1")).otherwise(x))  # token by token, so linear in the text


def is_prose(text: Column) -> Column:
    """Not a data object (keys are KEYS or more of its length) and not a log (assignments are ASSIGNMENTS or more); markup does not count."""
    t = F.when(F.contains(text, F.lit("<")), F.regexp_replace(text, TAG, " ")).otherwise(text)
    taken = lambda of: F.aggregate(F.regexp_extract_all(t, F.lit(of), F.lit(0)), F.lit(0), lambda s, x: s + F.length(x))
    few = lambda mark, of, most: ~F.contains(text, F.lit(mark)) | (taken(of) < most * F.greatest(F.length(t), F.lit(1)))
    return few('"', r'"\w++"\s*+:', KEYS) & few("=", r"\b\w++=\S++", ASSIGNMENTS)


def language(lang: Column) -> Column:
    """Two-letter language of a label however it is spelled (``en-US``, ``EN``); null without one."""
    s = F.regexp_extract(F.lower(lang), r"^\s*([a-z]{2})", 1)
    return F.when(s != "", s)


def document_words(documents: DataFrame) -> DataFrame:
    """``doc_id, prose, lang, words_per_sentence, commas_per_sentence, word, c``: each word of each text with words, counted, in one pass without a shuffle.

    A text that has words only in what ``prose_text`` takes out (a log of assignments, say) is measured as it stands. The measures of
    the text stand on each of its rows, where they cost next to nothing once written by column. Texts under one id count as one document.
    """
    label = language(F.col("lang")) if "lang" in documents.columns else F.lit(None).cast("string")
    text = F.col("text")
    m = let(let(prose_text(text), lambda p: F.when(p.rlike(r"\p{L}"), p).otherwise(text)), _measures)  # each pattern runs once over a text
    d = documents.where("text is not null and doc_id is not null").select("doc_id", label.alias("lang"), is_prose(text).alias("prose"), m.alias("m"))
    return d.select("doc_id", "lang", "prose", "m.words_per_sentence", "m.commas_per_sentence", F.explode("m.words").alias("w")).select("doc_id", "lang", "prose", "words_per_sentence", "commas_per_sentence", "w.word", "w.c")


def counted(words: Column) -> Column:
    """array<struct<word,c>> of an array's distinct words, by the starts of the runs in the sorted array: nothing is shuffled."""

    def runs(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return let(starts, lambda at: F.transform(at, lambda i, k: F.struct(F.get(s, i).alias("word"), (F.coalesce(F.get(at, k + 1), F.size(s)) - i).cast("bigint").alias("c"))))

    return let(F.sort_array(words), lambda s: F.when(F.size(s) > 0, runs(s)))


def _measures(clean: Column) -> Column:
    """Struct of a text's words (in lower case) and its sentence measures."""
    sentences = F.greatest(F.regexp_count(clean, F.lit(r"[.!?;:]++(?:\s|$)|\n++\s*+\S")), F.lit(1))
    commas = F.length(clean) - F.length(F.replace(clean, F.lit(",")))
    words = F.regexp_extract_all(F.lower(clean), F.lit(r"[a-z\p{L}]++"), F.lit(0))
    return let(F.struct(words.alias("w"), sentences.alias("s"), commas.alias("c")), lambda x: F.struct(counted(x["w"]).alias("words"), F.ln(F.size(x["w"]) / x["s"]).alias("words_per_sentence"), (x["c"] / x["s"]).alias("commas_per_sentence")))


def word_ranks(counts: DataFrame) -> DataFrame:
    """``word, rank`` by falling frequency; words of equal count share the last rank of their run.

    Ranks come from the number of words per count, so the vocabulary itself is never sorted in one place.
    """
    runs = counts.groupBy("cnt").agg(F.count("*").alias("k"))
    w = Window.partitionBy(F.lit(0)).orderBy(F.col("cnt").desc())
    ranks = runs.select("cnt", F.sum("k").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("rank"))
    return counts.join(ranks, "cnt").select("word", "rank")


def word_features(counts: DataFrame, alpha: float = 0.5) -> DataFrame:
    """Words (``word, cnt, en, other``) with their rank and what the measures of a text need of them, once per word instead of once per use.

    ``odds`` is the word's evidence for English: the log of its smoothed share among the words of texts labelled English over that among
    the words of texts labelled otherwise (naive Bayes, fitted here on the corpus's own labels; without labels it is 0).
    """
    w = F.col("word")
    bit = lambda c: c.cast("int")
    t = counts.agg(F.sum("en").alias("__e"), F.sum("other").alias("__o"), F.count("*").alias("__v"))  # one row
    share = lambda c, n: (F.col(c) + alpha) / (F.col(n) + alpha * F.col("__v"))
    odds = counts.crossJoin(F.broadcast(t)).select("word", F.ln(share("en", "__e") / share("other", "__o")).alias("odds"))
    ranks = word_ranks(counts).join(odds, "word")
    return ranks.select("word", "rank", "odds", bit(w.isin(CLAUSE_WORDS)).alias("clause"), bit(w.rlike(DERIVED)).alias("derived"), bit(w.isin("the", "a")).alias("article"), F.length("word").alias("len"))


def document_features(documents: DataFrame) -> DataFrame:
    """``doc_id, n, is_english_prose`` and FEATURES of each text with words.

    ``c50 ..`` are logs of the size of the smallest frequency-ranked vocabulary that covers each of SHARES of a document's words. The
    vocabulary is broadcast within the bounds of ``fits_broadcast``; beyond them a word that is in every document is split over tasks.
    """
    pairs = written(document_words(documents))
    of = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("c"))), F.lit(0))
    counts = checkpointed(pairs.groupBy("word").agg(F.sum("c").alias("cnt"), of(F.col("lang") == "en").alias("en"), of(F.col("lang") != "en").alias("other")))
    ranked = guarded_join(pairs.drop("lang"), word_features(counts), ["word"], "inner")
    w = Window.partitionBy("doc_id")
    run = ranked.drop("word").withColumn("cum", F.sum("c").over(w.orderBy("rank"))).withColumn("n", F.sum("c").over(w))
    share = lambda c: F.sum(F.col(c) * F.col("c")) / F.max("n")
    return run.groupBy("doc_id").agg(
        F.max("n").cast("double").alias("n"), (F.bool_and("prose") & (F.sum(F.col("odds") * F.col("c")) >= 0)).alias("is_english_prose"),
        *[F.ln(F.min(F.when(F.col("cum") >= F.col("n") * p, F.col("rank")))).alias(f"c{round(p * 100)}") for p in SHARES], F.max("words_per_sentence").alias("words_per_sentence"), F.max("commas_per_sentence").alias("commas_per_sentence"),
        share("clause").alias("clause_share"), share("len").alias("word_length"), share("derived").alias("derived_share"), share("article").alias("article_share"),
    ).select("doc_id", "n", "is_english_prose", *FEATURES)


def rated_documents(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Features and mean rating ``y`` of every rated document in English prose, which the ratings speak for."""
    rated = labels.where("reading_level between 1 and 5").groupBy("doc_id").agg(F.avg("reading_level").alias("y"))
    return features.where("is_english_prose").join(rated, "doc_id").select("doc_id", "y", F.array(*FEATURES).alias("x"))


def level_weights(rated: DataFrame, by: list[str] | None = None, ridge: float = 1.0) -> DataFrame:
    """``by, w``: weights of intercept and FEATURES by ridge regression on ``x`` and ``y``, one row a group, all of it in SQL.

    Features are centred and scaled by their deviation over the rated rows, sums of products come from one aggregation, and Gauss-Jordan
    elimination over the ten rows of the normal equations is a fold over arrays. Without rated rows the weights are null.
    """
    by, k = by or [], len(FEATURES)
    at = lambda a, i: F.get(a, F.lit(i))
    stats = rated.groupBy(*by).agg(F.array(*[F.avg(at("x", i)) for i in range(k)]).alias("mu"), F.array(*[F.greatest(F.stddev_pop(at("x", i)), F.lit(1e-6)) for i in range(k)]).alias("sd"))
    one = F.broadcast(stats)  # a row a group
    x = rated.join(one, by) if by else rated.crossJoin(one)
    z = x.select(*by, "y", F.concat(F.array(F.lit(1.0)), F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: (F.get("x", i) - F.get("mu", i)) / F.get("sd", i))).alias("z"))
    cross = lambda i, j: F.sum(at("z", i) * (F.col("y") if j > k else at("z", j)))
    cell = lambda i, j: cross(min(i, j), max(i, j)) + (ridge if i == j and i else 0.0)
    m = z.groupBy(*by).agg(F.array(*[F.array(*[cell(i, j) for j in range(k + 1)], cross(i, k + 1)) for i in range(k + 1)]).alias("m"))

    def clear(rows: Column, p: Column) -> Column:
        lead = F.transform(F.get(rows, p), lambda v: v / F.get(F.get(rows, p), p))
        return F.transform(rows, lambda r, i: F.when(i == p, lead).otherwise(F.zip_with(r, lead, lambda a, b: a - b * F.get(r, p))))

    solved = F.aggregate(F.sequence(F.lit(0), F.lit(k)), F.col("m"), clear, lambda rows: F.transform(rows, lambda r: F.get(r, F.lit(k + 1))))
    s = m.select(*by, solved.alias("q"))
    s = s.join(one, by) if by else s.crossJoin(one)
    slopes = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.get("q", i + 1) / F.get("sd", i))
    s = s.select(*by, F.get("q", F.lit(0)).alias("q0"), "mu", slopes.alias("b"))
    shift = F.aggregate(F.zip_with("b", "mu", lambda a, c: a * c), F.lit(0.0), lambda t, v: t + v)
    return s.select(*by, F.concat(F.array(F.col("q0") - shift), "b").alias("w"))


def level_of(w: Column, x: Column) -> Column:
    """Level, 1 to 5, of a text's features ``x`` under the weights ``w``."""
    raw = F.aggregate(F.zip_with(F.concat(F.array(F.lit(1.0)), x), w, lambda a, b: a * b), F.lit(0.0), lambda t, v: t + v)
    return F.when(raw.isNotNull(), F.least(F.greatest(raw, F.lit(1.0)), F.lit(5.0)))


def text_levels(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, level`` (1 to 5, continuous), ``coverage_rank`` (at 95 % of the words), ``words_per_sentence`` and ``is_english_prose``.

    Every text with words has a row. The ratings are of English prose, so elsewhere (data objects, logs, other languages) the level
    carries their measures on and is the less sure. A repeated ``doc_id`` counts once. Without ratings the level is null.
    """
    f = written(document_features(documents))
    w = checkpointed(level_weights(rated_documents(f, labels)))
    level = level_of(F.col("w"), F.array(*FEATURES))
    return f.crossJoin(F.broadcast(w)).select("doc_id", level.alias("level"), F.round(F.exp("c95")).cast("bigint").alias("coverage_rank"), F.round(F.exp("words_per_sentence"), 4).alias("words_per_sentence"), "is_english_prose")


def held_out_accuracy(documents: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """``fold, documents, mean_abs_error, within_one, right_side``: each fold of the rated documents judged by the fit on the others.

    ``right_side`` is the share on the same side of level 4 (to the nearest level) as its mean rating.
    """
    rated = checkpointed(rated_documents(written(document_features(documents)), labels).withColumn("of", F.pmod(F.xxhash64("doc_id"), F.lit(folds)).cast("int")))
    others = rated.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))).where("fold <> of")
    w = checkpointed(level_weights(others, ["fold"]))
    d = rated.withColumnRenamed("of", "fold").join(F.broadcast(w), "fold").withColumn("level", level_of(F.col("w"), F.col("x")))
    err = F.abs(F.col("level") - F.col("y"))
    side = (F.col("level") >= 3.5) == (F.col("y") >= 3.5)
    return d.groupBy("fold").agg(F.count("*").alias("documents"), F.round(F.avg(err), 4).alias("mean_abs_error"), F.round(F.avg((err <= 1).cast("int")), 4).alias("within_one"), F.round(F.avg(side.cast("int")), 4).alias("right_side"))


def reading_levels(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``text_levels`` in English prose, which the ratings speak for."""
    return text_levels(documents, labels).where("is_english_prose").drop("is_english_prose")


def demanding(levels: DataFrame, least: int = 4) -> DataFrame:
    """Documents at reading level ``least`` or above, to the nearest level."""
    return levels.where(F.col("level") >= least - 0.5).select("doc_id")


def profile(documents: DataFrame, levels: DataFrame) -> DataFrame:
    """Documents by source and nearest level, and their mean coverage rank. Texts without words count at a null level."""
    s = F.lower(F.trim("source"))
    d = documents.select("doc_id", F.when(s != "", s).alias("source")).join(levels, "doc_id", "left")
    return d.groupBy("source", F.round("level").cast("int").alias("reading_level")).agg(F.count("*").alias("documents"), F.round(F.avg("coverage_rank"), 2).alias("mean_coverage_rank"))
