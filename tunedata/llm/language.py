"""Language identification by compression.

For every language a raw-content Zstandard dictionary is cut from sampled training texts. A text is
compressed once with each dictionary; the smallest result names the language, and where the two
smallest differ by too little the guess is rejected. Texts and dictionaries are first reduced to
lower-case words, since capitals, digits and punctuation say nothing of the language.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunedata.llm.common import internal, tidied

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLES = 200  # training texts per language
PIECE = 600  # characters taken of each
LEVEL = 5
MARGIN = 0.02  # least relative advantage over the second language
LANGUAGES = 500  # more learned values than that are refused
SHARPNESS = 40.0
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def reduced(text: str) -> bytes:
    """Lower-case letters and single blanks, in UTF-8."""
    return _NOT_LETTERS.sub(" ", text.lower()).encode("utf-8", "replace")


def learn_dictionaries(
    labelled: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    samples: int = SAMPLES,
    piece: int = PIECE,
) -> dict[str, bytes]:
    """One raw-content dictionary per language of ``labelled``, from at most ``samples`` texts each.

    The sample is fixed by a hash of the key: rows below a threshold that leaves about four times
    as many as needed, then the smallest hashes. Null languages and texts without words teach
    nothing. What reaches the driver is bounded by languages, samples and piece.
    """
    place = F.xxhash64(F.col(key).cast("string"), F.xxhash64(text))
    rows = labelled.filter(F.col(lang).isNotNull() & F.col(text).rlike(r"\S")).select(
        F.col(lang).alias("lang"),
        F.col(text).alias("text"),
        (place.cast("double") / 2.0**64 + 0.5).alias("place"),
    )
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("size")).limit(LANGUAGES + 1).collect()
    if len(sizes) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not sizes:
        return {}
    limits = F.create_map(
        *[F.lit(x) for row in sizes for x in (row["lang"], min(2.0, 4.0 * samples / row["size"]))]
    )
    few = rows.filter(F.col("place") < F.element_at(limits, F.col("lang")))
    # A piece from a place within the text that the hash decides, not its beginning.
    start = F.floor(F.col("place") * 7919 % 1 * F.greatest(F.length("text") - piece, F.lit(0))) + 1
    pieces = few.select("lang", "place", F.substring("text", start.cast("int"), F.lit(piece)).alias("piece"))
    first = Window.partitionBy("lang").orderBy("place", "piece")
    chosen = pieces.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= samples)
    found: dict[str, list[tuple[int, str]]] = {}
    for row in chosen.select("lang", "n", "piece").collect():
        found.setdefault(row["lang"], []).append((row["n"], row["piece"]))
    return {k: reduced(" ".join(p for _, p in sorted(v))) for k, v in sorted(found.items())}


def _compressors(dictionaries: dict[str, bytes], level: int) -> list[zstandard.ZstdCompressor]:
    found = []
    for content in dictionaries.values():
        data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(level=level)
        found.append(
            zstandard.ZstdCompressor(
                dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False
            )
        )
    return found


def compressed_sizes(text: str, compressors: list[zstandard.ZstdCompressor]) -> np.ndarray:
    data = reduced(text)
    return np.array([len(c.compress(data)) for c in compressors], dtype=float)


def judge(sizes: np.ndarray) -> tuple[int, float, float]:
    """Index of the smallest (first of equals), score, and relative margin to the second."""
    best = int(np.argmin(sizes))
    relative = (sizes - sizes[best]) / sizes[best]
    score = float(1 / np.exp(-SHARPNESS * relative).sum())
    margin = float(np.partition(relative, 1)[1]) if len(sizes) > 1 else 1.0
    return best, score, margin


def _predict(dictionaries: dict[str, bytes], column: str, added: tuple[str, str, str], level: int, margin: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, compressors = list(dictionaries), _compressors(dictionaries, level)
        for batch in batches:
            lang, score, accepted = [], [], []
            has_letter = batch.column(batch.num_columns - 1).to_pylist()
            texts = batch.column(batch.schema.get_field_index(column))
            for at in range(batch.num_rows):
                if not has_letter[at] or not names:
                    guess = ("und", 0.0, False)
                else:
                    best, sure, ahead = judge(compressed_sizes(texts[at].as_py(), compressors))
                    guess = (names[best], sure, ahead >= margin)
                for column_, value in zip((lang, score, accepted), guess, strict=True):
                    column_.append(value)
            arrays = [batch.column(i) for i in range(batch.num_columns - 1)]
            arrays += [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(accepted, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[:-1], *added])

    return run


def identify(
    docs: DataFrame,
    dictionaries: dict[str, bytes],
    text: str = "text",
    names: tuple[str, str, str] = ("lang_pred", "lang_score", "lang_accepted"),
    level: int = LEVEL,
    margin: float = MARGIN,
) -> DataFrame:
    """Add the predicted language, its score in (0, 1] and whether the margin is wide enough.

    A null text, one without a letter, or an empty set of languages gives ``und``, score 0, not
    accepted. Every whole text is compressed; rows stay where they are. ``names`` must not clash
    with columns of ``docs``.
    """
    if internal(docs, *names) != list(names):
        raise ValueError("the added names clash with columns of the table")
    (flag,) = internal(docs, "_letter")
    ready = docs.withColumn(flag, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    schema = docs.select("*").schema  # one of its own, since add() changes it
    for name, kind in zip(names, ("string", "double", "boolean"), strict=True):
        schema = schema.add(name, kind)
    return ready.mapInArrow(tidied(_predict(dictionaries, text, names, level, margin)), schema)
