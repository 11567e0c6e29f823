"""Benchmark decontamination by spaced seeds. DataFrame functions only.

Texts become lower-case runs of letters and digits. A mask keeps three pairs of neighbouring tokens
and ignores those between them; the kept tokens of every window of every document and of every
benchmark item are hashed and joined. A hit fixes an alignment of item and document, and an item
counts as contained where at least ``share`` of its tokens agree with the document under it, so
substituted words are tolerated both by the seeds and by the verdict.

Items shorter than the masks have to be found whole: their tokens, hashed in one, meet the runs of
that many tokens of every document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunedata.llm.common import broadcast_if_small, internal, materialize

# Offsets of the kept pairs: 1100110011, 11001111, 111100011 (1: kept).
MASKS = ((0, 4, 8), (0, 4, 6), (0, 2, 7))
SHARE = 0.5
SEED_ROWS = 500_000
# Items of fewer tokens than this count only where they make up the whole document.
LEAST_RUN = 4
_SEPARATOR = r"[^\p{L}\p{N}]+"
# Scripts that are written without spaces: every character is a token.
_UNSPACED = r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}])"


def tokens(text: str | Column) -> Column:
    """Lower-case runs of letters and digits; single characters in scripts without spaces."""
    column = F.lower(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))
    spaced = F.when(column.rlike(_UNSPACED), F.regexp_replace(column, _UNSPACED, " $1 ")).otherwise(column)
    return F.array_remove(F.split(spaced, _SEPARATOR), "")


def _span(mask: tuple[int, ...]) -> int:
    return mask[-1] + 2


def _windows(count: Column, mask: tuple[int, ...]) -> Column:
    return F.greatest(count - (_span(mask) - 1), F.lit(0))


def _with_seeds(rows: DataFrame, text: str, *keep: str) -> DataFrame:
    """``keep``, n and seeds: the hashes of all windows, mask after mask.

    The lambdas refer to columns of an earlier projection, so nothing is computed per window but
    one hash over three numbers.
    """
    words = rows.select(*keep, tokens(text).alias("words"))
    hashed = words.select(
        *keep, F.size("words").alias("n"), F.transform("words", lambda w: F.xxhash64(w)).alias("h")
    )
    pairs = hashed.select(
        *keep,
        "n",
        F.zip_with(
            F.slice("h", 1, F.greatest(F.col("n") - 1, F.lit(0))),
            F.slice("h", 2, F.greatest(F.col("n") - 1, F.lit(0))),
            lambda a, b: F.xxhash64(a, b),
        ).alias("pairs"),
    )

    def seeds(number: int, mask: tuple[int, ...]) -> Column:
        def seed(first: Column, at: Column) -> Column:
            later = [F.get("pairs", at + gap) for gap in mask[1:]]
            return F.xxhash64(F.lit(number), first, *later)

        return F.transform(F.slice("pairs", 1, _windows(F.col("n"), mask)), seed)

    return pairs.select(*keep, "n", F.concat(*[seeds(i, m) for i, m in enumerate(MASKS)]).alias("seeds"))


def _positions(rows: DataFrame, *keep: str) -> DataFrame:
    # The outer form: for the inner one Spark would add a filter on the size of ``seeds`` and push
    # it, with all that it takes to compute them once more, below the projections.
    return rows.select(*keep, "n", F.posexplode_outer("seeds").alias("place", "seed"))


def _offset(place: Column, count: Column) -> Column:
    """Token position of the window at ``place`` in the list of all masks' windows."""
    lengths = [_windows(count, mask) for mask in MASKS]
    starts = [reduce(lambda a, b: a + b, lengths[:i], F.lit(0)) for i in range(len(MASKS))]
    found = place
    for start in starts[1:]:
        found = F.when(place >= start, place - start).otherwise(found)
    return found


def _whole_items(texts: DataFrame, words: DataFrame) -> DataFrame:
    """(doc_key, item_key, matches, n): the items with fewer tokens than any mask that stand whole in a text.

    ``words`` has item_key and item_words. A run of tokens is told by two hashes, 128 bits together.
    """
    n = F.size("item_words")
    short = words.filter((n > 0) & (n < min(_span(mask) for mask in MASKS)))

    def named(run: Column) -> Column:
        return F.struct(F.xxhash64(run).alias("seed"), F.xxhash64(F.lit(1), run).alias("check"))

    items = short.select("item_key", n.alias("n"), F.inline(F.array(named(F.col("item_words")))))
    lengths = [row["n"] for row in items.select("n").distinct().orderBy("n").collect()]  # 7 at most
    if not lengths:
        return items.select(F.col("item_key").alias("doc_key"), "item_key", F.col("n").alias("matches"), "n").limit(0)
    cut = texts.select("text_key", tokens("text").alias("words"))

    def runs(length: int) -> Column:
        if length < LEAST_RUN:
            whole = F.array(F.col("words"))
            return F.when(F.size("words") == length, whole).otherwise(F.slice(whole, 1, 0))
        starts = F.slice(F.col("words"), 1, F.greatest(F.size("words") - (length - 1), F.lit(0)))
        return F.transform(starts, lambda _, i: F.slice("words", i + 1, length))

    found = cut.select("text_key", F.explode(F.concat(*(runs(length) for length in lengths))).alias("run"))
    hashed = found.select("text_key", named(F.col("run")).alias("h")).select("text_key", "h.seed", "h.check")
    known = items.select("item_key", "n", F.col("seed").alias("s"), F.col("check").alias("c"))
    same = (F.col("seed") == F.col("s")) & (F.col("check") == F.col("c"))
    hits = hashed.join(broadcast_if_small(known, SEED_ROWS), same).select("text_key", "item_key", "n").distinct()
    return hits.select(F.col("text_key").alias("doc_key"), "item_key", F.col("n").alias("matches"), "n")


def contaminations(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    share: float = SHARE,
) -> DataFrame:
    """One row per document row and item it contains: key, item, n_matches, n_tokens.

    Null and empty texts contain nothing. An item with fewer tokens than the shortest mask (8) is
    contained where all its tokens follow each other in the document; with fewer than ``LEAST_RUN``
    (4), which ordinary text is full of, only where they are the whole document. An item without a
    token matches nothing. Repeated documents and items give rows of their own; an empty table on
    either side gives an empty result.

    The seeds of all documents meet those of the benchmark, which are broadcast if counting shows
    at most ``SEED_ROWS`` and shuffled otherwise. Only hits, which are few, are written; texts are
    not shuffled unless the hits are too many to broadcast.
    """
    items = benchmark.select(F.col(item).alias("item"), F.col(item_text).alias("item_text")).filter(
        F.col("item_text").isNotNull()
    )
    items = items.withColumn("item_key", F.xxhash64("item_text"))
    known, _ = materialize(
        _positions(_with_seeds(items.dropDuplicates(["item_key"]), "item_text", "item_key"), "item_key")
        .select("seed", "item_key", F.col("place").alias("item_place"), F.col("n").alias("item_n"))
        .withColumn("item_at", _offset(F.col("item_place"), F.col("item_n")))
        .select("seed", "item_key", "item_at")
        .filter(F.col("seed").isNotNull()),
        "seeds",
    )
    texts = docs.select(F.xxhash64(text).alias("text_key"), F.col(text).alias("text")).filter(
        F.col("text").isNotNull()
    )
    hits = (
        _positions(_with_seeds(texts, "text", "text_key"), "text_key")
        .join(broadcast_if_small(known, SEED_ROWS), "seed")
        .withColumn("shift", _offset(F.col("place"), F.col("n")) - F.col("item_at"))
        .select("text_key", "item_key", "shift")
        .distinct()
    )
    hits, _ = materialize(hits, "hits")

    # A few tokens of each item go with its hits; only documents with hits are cut into words again.
    words = items.select("item_key", tokens("item_text").alias("item_words")).dropDuplicates(["item_key"])
    aligned = hits.join(words, "item_key")
    found_docs = docs.select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("doc_key")
    ).filter(F.col("text").isNotNull())
    keys = hits.select("text_key").distinct()
    few = broadcast_if_small(keys)
    candidates = found_docs.join(few, F.col("doc_key") == F.col("text_key"), "left_semi")
    # Verdicts are per text; the documents that share it are looked up last.
    one_each = candidates.dropDuplicates(["doc_key"]).select("doc_key", tokens("text").alias("words"))
    joined = one_each.join(aligned, F.col("doc_key") == F.col("text_key"))
    same = F.filter(
        F.sequence(F.lit(0), F.size("item_words") - 1),
        lambda i: F.get("words", i + F.col("shift")) == F.get("item_words", i),
    )
    judged = (
        joined.select("doc_key", "item_key", F.size(same).alias("matches"), F.size("item_words").alias("n"))
        .groupBy("doc_key", "item_key")
        .agg(F.max("matches").alias("matches"), F.max("n").alias("n"))
        .filter(F.col("matches") >= F.ceil(F.col("n") * share))
    )
    whole = _whole_items(texts, words)
    judged, _ = materialize(judged.unionByName(whole.select(judged.columns)), "contaminated")
    verdicts = broadcast_if_small(judged)
    named = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("own_key")).join(
        verdicts, F.col("own_key") == F.col("doc_key")
    )
    return named.join(items.select("item", F.col("item_key").alias("k")), F.col("item_key") == F.col("k")).select(
        F.col("key").alias(key),
        F.col("item").alias(item),
        F.col("matches").cast("bigint").alias("n_matches"),
        F.col("n").cast("bigint").alias("n_tokens"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that contain no item of ``benchmark``, with their own columns."""
    (mark,) = internal(docs, "_text_key")
    keyed = docs.withColumn(mark, F.xxhash64(text))
    found = contaminations(keyed, benchmark, key=mark, text=text, **options)
    bad, _ = materialize(found.select(F.col(mark).alias("bad")).distinct(), "contaminated-texts")
    clean = keyed.join(broadcast_if_small(bad), F.col(mark) == F.col("bad"), "left_anti")
    return clean.select(*[F.col(f"`{c}`") for c in docs.columns])
