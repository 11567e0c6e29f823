import gc
import hashlib
import json
import random
import re
import tracemalloc
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given as gives
from hypothesis import settings
from hypothesis import strategies as st
from llm_cases import CLASH, documents, frame

from tunedata.llm import mixing
from tunedata.llm import token_files as tf
from tunedata.llm.common import scratch
from tunedata.llm.queries import default_tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fill(sizes, weights, budget, cap):
    """Water filling by bisection."""
    low, high = 0.0, 1e12
    for _ in range(300):
        level = (low + high) / 2
        if sum(min(cap * s, w * level) for s, w in zip(sizes, weights, strict=True)) < budget:
            low = level
        else:
            high = level
    return [min(cap * s, w * high) for s, w in zip(sizes, weights, strict=True)]


def fair_queue(rows):
    """Copies taken of each row (by its place in ``rows``): a plain queue, cut at the budget."""
    size = [len(WORD.findall(row[1] or "")) for row in rows]
    names = sorted({row[3] for row in rows}, key=lambda s: (s is None, s))
    copies = []
    for turn, name in enumerate(names):
        own = [i for i, row in enumerate(rows) if row[3] == name]
        own.sort(key=lambda i: (hashlib.md5(str(first_known(*rows[i][:2])).encode()).digest(), size[i]))
        served = 0
        for _ in range(3):
            for i in own:
                served += size[i]
                copies.append((Fraction(served, (5, 2, 1)[turn % 3]), turn, i))
    taken, left = Counter(), sum(size)
    for *_, i in sorted(c for c in copies if size[c[2]]):
        left -= size[i]
        if left < 0:
            break
        taken[i] += 1
    return size, taken


def first_known(*values):
    return next((v for v in values if v is not None), "")


def test_targets_and_shares(spark):
    rows = documents() + [(9000 + i, "w " * (i % 50), "en", f"big{i % 2}", 0, *"abcdefg") for i in range(400)]
    found = mixing.mixed_sizes(frame(spark, rows)).collect()
    size, taken = fair_queue(rows)
    expected = Counter((row[0], size[i], size[i] * taken[i]) for i, row in enumerate(rows))
    assert Counter((r.doc_id, r.size, r.taken) for r in found) == expected
    sizes = Counter()
    for i, row in enumerate(rows):
        sizes[row[3]] += size[i]
    names = sorted(sizes, key=lambda s: (s is None, s))
    weights = [(5, 2, 1)[i % 3] for i in range(len(names))]
    targets = fill([sizes[s] for s in names], weights, sum(sizes.values()), 3)
    target = dict(zip(names, targets, strict=True))
    source = {r[0]: r[3] for r in rows}
    for row in found:
        s = source[row.doc_id] if row.doc_id is not None else "src3"
        assert row.source_size == sizes[s]
        assert row.target == pytest.approx(target[s], rel=1e-9)
        assert row.taken <= 3 * row.size
    total = sum(sizes.values())
    assert total - max(size) < sum(r.taken for r in found) <= total


def test_budget_is_spent_and_sources_come_near_their_targets(spark):
    rows = [(i, "w " * (i % 30 + 1), "en", f"s{i % 7}", 0, *CLASH) for i in range(7000)]
    found = mixing.mixed_sizes(frame(spark, rows)).collect()
    assert 0 <= sum(r.size for r in found) - sum(r.taken for r in found) < 30
    taken, target = Counter(), {}
    for r in found:
        taken[r.doc_id % 7] += r.taken
        target[r.doc_id % 7] = r.target
    assert all(abs(taken[s] - target[s]) <= 60 for s in target)


def test_many_rows_without_ids(spark):
    rows = [(None, "w " * (i % 40) + str(i), "en", None, 0, *CLASH) for i in range(600)]
    docs = frame(spark, rows)
    size, taken = fair_queue(rows)
    expected = Counter({rows[i][1]: n for i, n in taken.items()})
    assert Counter(r.text for r in mixing.mix(docs).collect()) == expected


def test_result_does_not_depend_on_buckets_or_partitions(spark):
    one = sorted(map(str, mixing.mixed_sizes(frame(spark, parts=1), buckets=1).collect()))
    many = sorted(map(str, mixing.mixed_sizes(frame(spark, parts=9), buckets=500).collect()))
    assert one == many


def test_mix_takes_what_the_sizes_say(spark):
    rows = documents()
    docs = frame(spark, rows)
    found = mixing.mix(docs)
    assert found.columns == docs.columns
    _, taken = fair_queue(rows)
    expected = Counter()
    for i, n in taken.items():
        expected[rows[i][:4]] += n
    assert Counter((r.doc_id, r.text, r.lang, r.source) for r in found.collect()) == expected


def test_mix_of_repeated_rows_and_of_nothing(spark):
    rows = [(7, "a b c", "en", "s", 5, *"abcdefg")] * 4
    assert mixing.mix(frame(spark, rows)).count() == 4
    rows += [(7, "x y z", "en", "t", 5, *"abcdefg"), (7, "d e f", "en", "s", 5, *"abcdefg")]
    found = Counter((r.source, r.text) for r in mixing.mix(frame(spark, rows)).collect())
    assert sum(found.values()) == 6 and found["t", "x y z"] <= 3 and found["s", "d e f"] <= 3
    assert mixing.mix(frame(spark, [])).collect() == []
    assert mixing.mixed_sizes(frame(spark, [])).collect() == []


@settings(max_examples=60, deadline=None)
@gives(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=300))
def test_packing_round_trip(bits, ids):
    ids = np.array([i & ((1 << bits) - 1) for i in ids], np.uint32)
    data = tf.pack(ids, bits)
    assert len(data) == -(-len(ids) * bits // 8)
    assert tf.unpack(data, bits, len(ids)).tolist() == ids.tolist()


def test_bits():
    assert [tf.bits_for(n) for n in (1, 2, 3, 256, 257, 50_257)] == [1, 1, 2, 8, 9, 16]
    with pytest.raises(ValueError):
        tf.pack(np.array([8], np.uint32), 3)


def test_file_random_access(tmp_path):
    random = np.random.default_rng(1)
    docs = [random.integers(0, 50_000, random.integers(0, 400)).astype(np.uint32) for _ in range(60)]
    path = tmp_path / "x.tok"
    with open(path, "wb") as out:
        writer = tf.TokenWriter(out, 17, block_ids=100)
        for key, ids in enumerate(docs):
            writer.add(None if key == 5 else key, ids)
        writer.close()
    every = np.concatenate(docs)
    with open(path, "rb") as source:
        reader = tf.TokenReader(source, path.stat().st_size)
        assert [(k, i.tolist()) for k, _, i in reader.documents()] == [
            (None if k == 5 else k, d.tolist()) for k, d in enumerate(docs)
        ]
        for start in (0, 1, 99, 100, 101, len(every) - 1):
            assert reader.read(start, 1).tolist() == every[start : start + 1].tolist()
        assert reader.read(50, 500).tolist() == every[50:550].tolist()
    with open(path, "rb") as source, pytest.raises(ValueError):
        tf.TokenReader(source, path.stat().st_size - 1)


CHARACTERS = st.sampled_from(list("ab Zé'’.!-\n\t\r\x0b\x1c\x85\xa0 　日1٣²ß🙂́<|>_"))


@settings(max_examples=300, deadline=None)
@gives(st.lists(st.one_of(CHARACTERS, st.sampled_from(["<|endoftext|>", "can't ", "  ", "Wort,"])), max_size=40))
def test_encoder_equals_the_library(parts):
    text = "".join(parts)
    encoder = ENCODER
    assert encoder.encode([text])[0].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


ENCODER = tf.Encoder(default_tokenizer(), memo=50)


@pytest.mark.parametrize("special", [[], ["<|endoftext|>"]])
def test_texts_of_a_column_are_encoded_together(special):
    """White space of all kinds at cuts, special tokens, empty texts and a column that is a slice."""
    kinds = ["a", " ", "  ", "\n", "\xa0", "\u2003", "\u3000", "\x85", "é", "的", "\x1c", ".", "'s", "'reb", "1", "Z", "[", "\t", *special]
    draw = random.Random(5)
    texts = ["".join(draw.choice(kinds) for _ in range(draw.randint(0, 12))) for _ in range(5000)]
    whole = pa.array(["left out", *texts, "", "also left out"], pa.string())
    found = ENCODER.encode_column(whole.slice(1, len(texts) + 1))
    plain = ENCODER.tokenizer.encode_batch([*texts, ""], add_special_tokens=False)
    assert [ids.tolist() for ids in found] == [one.ids for one in plain]
    assert ENCODER.encode([]) == [] and ENCODER.encode(["", ""])[1].tolist() == []


def test_other_tokenizers_get_whole_texts(tmp_path):
    """One that lower-cases and one that knows a token with a space: neither may be cut."""
    with open(default_tokenizer(), encoding="utf-8") as source:
        spec = json.load(source)
    lower = spec | {"normalizer": {"type": "Lowercase"}}
    wide = json.loads(json.dumps(spec))
    wide["added_tokens"].append(wide["added_tokens"][0] | {"id": 50257, "content": "two words"})
    for n, other in enumerate((lower, wide)):
        path = tmp_path / f"{n}.json"
        path.write_text(json.dumps(other), encoding="utf-8")
        encoder = tf.Encoder(str(path))
        texts = ["Some TEXT with two words in it", "", "A b"]
        plain = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
        assert not encoder.cuts and [ids.tolist() for ids in encoder.encode(texts)] == [one.ids for one in plain]


def test_remembered_segments_take_little_memory():
    """as Python objects they took 136 bytes each, in every worker of an executor."""
    letters = str.maketrans("0123456789", "abcdefghij")
    texts = [" ".join(str(10**5 + n).translate(letters) for n in range(at, at + 5000)) for at in range(0, 60_000, 5000)]
    encoder = tf.Encoder(default_tokenizer())
    arrow = pa.total_allocated_bytes()
    tracemalloc.start()
    for text in texts:
        encoder.encode([text])
    gc.collect()
    held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - arrow
    tracemalloc.stop()
    assert held < 60_000 * 80


def test_forgotten_segments_are_encoded_again(monkeypatch):
    """Both bounds, by number and by bytes; what a batch brings beyond them, and segments met again and again."""
    draw = random.Random(3)
    texts = [" ".join(str(draw.randrange(400)) + draw.choice(["", "x" * 70]) for _ in range(90)) for _ in range(60)]
    plain = [ids.ids for ids in ENCODER.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for memo, size in ((40, 1 << 20), (300, 1 << 20), (10_000, 4000), (0, 0)):
        monkeypatch.setattr(tf, "MEMO_SIZE", size)
        encoder = tf.Encoder(default_tokenizer(), memo=memo)
        for text, ids in zip(texts, plain, strict=True):
            assert encoder.encode([text])[0].tolist() == ids
            assert len(encoder.known) <= memo and encoder.known.nbytes <= size + 8


def test_tokens_match_the_library(spark):
    rows = documents()
    found = tf.read_tokens(
        spark.createDataFrame(
            tf.write_tokens(frame(spark, rows), scratch(spark, "tok"), default_tokenizer()).collect(), tf.MANIFEST
        ),
        with_ids=True,
    ).collect()
    assert len(found) == len(rows)
    tokenizer = ENCODER.tokenizer
    ids = {r[0]: [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0] for r in rows}
    found.sort(key=lambda r: r.start)
    assert [r.key for r in found] == sorted((r[0] for r in rows), key=lambda k: (k is not None, k))
    start = 0
    for row in found:
        assert row.ids == ids[row.key] and row.start == start and row.n_tokens == len(row.ids)
        assert row.ids_crc32 == zlib.crc32(np.array(row.ids, "<u4").tobytes())
        start += len(row.ids)


def test_tokens_of_an_empty_table(spark):
    assert tf.tokenize(frame(spark, []), default_tokenizer()).collect() == []
