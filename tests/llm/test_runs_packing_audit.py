"""Periodic runs, pattern packing and the filter audit against brute force, and on awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import permutations

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from test_llm_operators import AWKWARD, SCHEMA, SF, encoding, sha
from tokenizers import Tokenizer

from sidewise.llm import filter_audit, pattern_packing, periodic_runs, registered
from sidewise.llm.common import stored, table

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENS = JSON, RANKS, public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def documents():
    return [(r["doc_id"], r["text"], r["lang"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame([(i, t, None if i == 3 else "en", None if i == 4 else "s", 1, "x", "y", "z", "w") for i, t in AWKWARD], SCHEMA)


# 11 --------------------------------------------------------------------------


def expected_runs(words):
    """(start, period, length) of every run, straight from the definition."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(6, 4 * q):
                found.setdefault((start, length), q)
    return sorted((s, q, n) for (s, n), q in found.items())


def expected_report(doc_id, text, rewrite):
    words = rewrite(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    runs = expected_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[2], r[1]), r[0], r[1]), default=None)
    dropped = {i for s, q, n in runs for i in range(s + q, s + n)}
    four = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return doc_id, len(runs), *four, sha("".join(f"{s},{n},{q}\n" for s, q, n in runs)), sha(kept)


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_runs_of_the_table(spark, documents):
    got = rows(registered.op11(spark, SF))
    assert got == Counter(expected_report(i, t, registered.echoed) for i, t, _ in documents)
    assert sum(r[1] > 0 for r in got) > 10


def repeating(rng):
    """Words with planted repetitions of many periods, nested, adjoining and broken by one word."""
    words = []
    while len(words) < 400:
        kind = rng.random()
        unit = [rng.choice("abcd") for _ in range(rng.choice([1, 1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31]))]
        if kind < 0.3:
            unit = unit * rng.choice([2, 4])
        words += (unit * rng.choice([3, 4, 5, 6]))[: -rng.choice([1, 2, 3])] if kind < 0.8 else [rng.choice("abcdefg") for _ in range(rng.randrange(9))]
    return " ".join(words)


def test_runs_of_planted_repetitions_in_tiles_of_any_size(spark):
    rng = random.Random(5)
    texts = [repeating(rng) for _ in range(25)] + ["a " * n for n in (5, 6, 7, 300)] + ["a b " * 4, "a b a b a b a", "a b c " * 60 + "d"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    expected = Counter(expected_report(i, t, periodic_runs.unchanged) for i, t in enumerate(texts))
    assert sum(r[1] for r in expected) > 100
    for tile_words in (8, 64, 16_384):
        assert rows(periodic_runs.report(docs, tile_words=tile_words)) == expected


def test_z_function():
    rng = random.Random(2)
    for n in (1, 2, 30, 200):
        codes = [rng.randrange(2) for _ in range(n)]
        for i, k in list(enumerate(periodic_runs.z_function(codes)))[1:]:
            assert codes[i : i + k] == codes[:k] and (i + k == n or codes[i + k] != codes[k])


def test_fragments_of_neighbouring_tiles_touch():
    codes = np.array([9, *([1, 2, 3] * 40), 8, 7])
    found = periodic_runs.octave_fragments(codes, 2)
    assert found.tolist() == [[3, 1, 118]]
    halves = [periodic_runs.octave_fragments(codes, 2, a, b) for a, b in ((0, 60), (60, 200))]
    assert periodic_runs.stitched(np.concatenate(halves)).tolist() == found.tolist()


def test_runs_of_awkward_rows(awkward):
    expected = Counter(expected_report(i, t, registered.echoed) for i, t in AWKWARD if i is not None)
    expected += Counter(expected_report(i, t, periodic_runs.unchanged) for i, t in AWKWARD if i is None)
    assert rows(periodic_runs.report(awkward, registered.echoed)) == expected
    assert periodic_runs.report(awkward.limit(0)).count() == 0


# 12 --------------------------------------------------------------------------


def expected_pieces(given, size=1024):
    library = Tokenizer.from_file(JSON)
    out = []
    for i, text in given:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % size or size
        cuts = [0, *range(first, len(ids), size), len(ids)] if len(ids) > size else [0, len(ids)]
        for number, (a, b) in enumerate(zip(cuts, cuts[1:])):
            out.append((i, number, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return Counter(out)


def check_packing(got, size=1024):
    """Pieces lie in their sequences without a gap; returns sequences and the least possible number."""
    places = defaultdict(list)
    for r in got:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= size
    return len(places), -(-sum(r["length"] for r in got) // size)


def test_packing_of_the_table(spark):
    for sf, most in ((SF, 1.03), ("/root/testdata/sf0.01", 1.005)):
        got = registered.op12(spark, sf).collect()
        given = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
        assert Counter(tuple(r)[:5] for r in got) == expected_pieces(given)
        used, least = check_packing(got)
        assert used <= most * least


def plain_best_fit(lengths, size):
    rooms = []
    for length in sorted(lengths, reverse=True):
        at = min((i for i, r in enumerate(rooms) if r >= length), key=lambda i: rooms[i], default=None)
        if at is None:
            rooms.append(size - length)
        else:
            rooms[at] -= length
    return len(rooms)


@pytest.mark.parametrize("size", [1, 7, 40, 1024])
def test_packed_patterns_use_up_the_histogram(size):
    rng = np.random.default_rng(size)
    for n in (0, 1, 5, 300, 3000):
        for skew in (1, 4):
            lengths = 1 + (rng.random(n) ** skew * size).astype(int).clip(0, size - 1)
            histogram = np.bincount(lengths, minlength=size + 1)
            packed = pattern_packing.pack_histogram(histogram)
            used = np.zeros_like(histogram)
            for content, count in packed:
                assert count > 0 and sum(a * t for a, t in content) <= size
                for length, times in content:
                    used[length] += count * times
            assert (used == histogram).all()
            sequences = sum(count for _, count in packed)
            assert sequences <= 1.02 * plain_best_fit(lengths.tolist(), size) + 2


def test_fit_beats_best_fit_on_large_histograms():
    rng = np.random.default_rng(0)
    histogram = np.bincount(1 + (rng.beta(1.2, 1.1, 400_000) * 1023).astype(int), minlength=1025)
    count = lambda groups: sum(c for _, c in groups)
    least = -(-int(histogram @ np.arange(1025)) // 1024)
    assert least <= count(pattern_packing.pack_histogram(histogram)) <= count(pattern_packing.best_fit(histogram))


def test_packing_of_awkward_rows(awkward):
    special = awkward.limit(1).withColumn("doc_id", F.lit(99)).withColumn("text", F.lit("end <|endoftext|> of text"))
    given = [*((i, t) for i, t in AWKWARD), (99, "end <|endoftext|> of text")]
    docs = awkward.unionByName(special)
    got = pattern_packing.pack(docs, *TOKENS, sequence_ids=64).collect()
    assert Counter(tuple(r)[:5] for r in got) == expected_pieces(given, 64)
    check_packing(got, 64)
    assert pattern_packing.pack(awkward.limit(0), *TOKENS).count() == 0


def test_sequences_hold_the_ids_of_their_pieces(spark, documents):
    docs = spark.createDataFrame([(i, t) for i, t, _ in documents[:60]], "doc_id bigint, text string")
    placed = stored(pattern_packing.pack(docs, *TOKENS, keep_ids=True), "test-packed")
    whole = {i: [*encoding().encode_ordinary(t or ""), 2] for i, t, _ in documents[:60]}
    read = {r["sequence_id"]: r for r in pattern_packing.sequences(placed).collect()}
    for piece in placed.collect():
        ids = np.frombuffer(read[piece["sequence_id"]]["ids"], "<u4")
        assert ids[piece["offset"] : piece["offset"] + piece["length"]].tolist() == whole[piece["doc_id"]][piece["start"] : piece["start"] + piece["length"]]


# 13 --------------------------------------------------------------------------


def expected_audit(given, labels):
    texts = defaultdict(list)
    for i, text, _ in given:
        texts[text or ""].append(i)
    flagged = defaultdict(list)
    for i, text, lang in given:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        ids = [x for x in texts[text] if x is not None]
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search("[#$%&*|]", text)), "E": i is not None and i > min(ids),
        }
        flagged[lang or ""].append((fails, *labels.get(i, (0, 0))))
    out = []
    for part, members in flagged.items():
        shapley, lines = Counter(), []
        for order in permutations("ABCDE"):
            for n, own in enumerate(order):
                kept = removed = redundant = unique = good = toxic = 0
                for fails, q, t in members:
                    earlier = any(fails[f] for f in order[:n])
                    kept += not earlier and not fails[own]
                    gone = not earlier and fails[own]
                    removed, good, toxic = removed + gone, good + (gone and q == 1), toxic + (gone and t == 1)
                    redundant += earlier and fails[own]
                    unique += fails[own] and sum(fails.values()) == 1
                shapley[own] += removed
                lines.append((part, "".join(order), n + 1, kept, removed, redundant, unique, good, toxic))
        out += [(*line, shapley[line[1][line[2] - 1]]) for line in lines]
    return Counter(out)


def test_audit_of_awkward_rows(spark, awkward):
    labels = spark.createDataFrame([(4, 1, 0, "a"), (4, 0, 1, "b"), (5, None, 1, "c"), (None, 1, 1, "d"), (6, 1, None, "e"), (77, 1, 1, "f")], "doc_id bigint, quality int, toxic int, part string")
    known = {4: (1, 1), 5: (0, 1), 6: (1, 0)}
    got = rows(filter_audit.audit(awkward, labels))
    assert got == expected_audit([(i, t, None if i == 3 else "en") for i, t in AWKWARD], known)
    assert filter_audit.audit(awkward.limit(0), labels).count() == 0
    assert rows(filter_audit.audit(awkward, labels.limit(0))) == expected_audit([(i, t, None if i == 3 else "en") for i, t in AWKWARD], {})


def test_copies_are_found_in_a_crowded_sketch(spark, documents, monkeypatch):
    given = [(i, t, "en" if i % 2 else None) for i, t, _ in documents] + [(10_000 + n, "the same line over and over", "en") for n in range(90)] + [(None, "the same line over and over", "de")]
    docs = spark.createDataFrame(given, "doc_id bigint, text string, lang string")
    labels = table(spark, SF, "labels").limit(0)
    expected = expected_audit(given, {})
    for cells in (1 << 20, 64):
        monkeypatch.setattr(filter_audit, "cells_for", lambda texts, cells=cells: cells)
        assert rows(filter_audit.audit(docs, labels)) == expected


def test_sketch_clears_unique_texts_only(spark):
    docs = spark.range(3000).selectExpr("id", "cast(id % 2500 as string) as text").select("text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("second"), "text").alias("h2"))
    cells = filter_audit.cells_for(3000)
    counts = spark.sparkContext.broadcast(filter_audit.sketch(docs, cells))
    got = docs.select("text", filter_audit.may_repeat(F.col("h1"), F.col("h2"), counts, cells).alias("repeats")).collect()
    assert all(r["repeats"] for r in got if int(r["text"]) < 500)
    assert sum(r["repeats"] for r in got if int(r["text"]) >= 500) < 20
    assert hashlib.sha256(counts.value).hexdigest() and len(counts.value) == cells // 4


def test_only_possible_repeats_carry_their_text(spark):
    plan = filter_audit.audit(table(spark, SF, "documents"), table(spark, SF, "labels"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("Aggregate") >= 3
