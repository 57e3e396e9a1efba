"""Corpus operators against brute force, and on nulls, empty, long, tied and repeated rows."""

import collections
import hashlib
import pathlib
import random
import textwrap
import tracemalloc
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tamiz.llm import (
    common,
    decontamination,
    labelled,
    license_scan,
    packing,
    quality_classifier,
    quality_rules,
    repeats,
    sharding,
    simhash,
    token_counts,
    toxicity,
)
from tamiz.llm.workload import LLM_ORACLES, LLM_QUERIES

BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, fingerprint string, "
    "shard int, row long, statistics int, bucket int, h long, text_digest string, item_id long, kept boolean"
)
LONG = " ".join(f"word{i % 997} other{i % 31}" for i in range(20_000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog, twice a day and never on Sundays, as far as anyone here knows."),
    (2, "The quick brown fox jumps over the lazy dog, twice a day and never on Sundays, as far as anyone here knows."),
    (2, "The quick brown fox jumps over the lazy dog, twice a day and never on Sundays, as far as anyone here knows."),
    (3, None),
    (4, ""),
    (5, " \t\n "),
    (6, LONG),
    (7, "é ñ ß あい \x00 naïve"),
    (None, "A text without an id but with a few words."),
    (None, None),
    (9, "a b"),
    (9, "c d e f"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(d, t, None, "s", None, 0.1, "f", 1, 2, 3, 4, 5, "x", 6, True) for d, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (2, 0, 1), (6, 1, 0), (7, 0, 1), (7, 1, 1), (None, 1, 1), (9, None, None)],
        "doc_id long, quality int, toxic int",
    )


@pytest.fixture(scope="module")
def oracle(small_dir):
    connection = duckdb.connect()
    for name in ("documents", "labels", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{small_dir}/{name}.parquet')")
    return connection


def texts_of(spark, small_dir):
    return {r.doc_id: r.text for r in common.load(spark, small_dir, "documents").collect()}


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_equals_sql(spark, small_dir, oracle, name):
    got = LLM_QUERIES[name](spark, small_dir)
    want = oracle.execute(LLM_ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(repr, want.fetchall())) == sorted(repr(tuple(r[c] for c in columns)) for r in got.collect())


# ---- packing


def test_packing_round_trip(spark, small_dir):
    whole = Tokenizer.from_file(BPE)
    rows = collections.defaultdict(list)
    sequences = set()
    for r in LLM_QUERIES["op1_packing"](spark, small_dir).collect():
        assert r.length & (r.length - 1) == 0 and r.length <= 2048 and r.offset == 0
        assert r.sequence_id not in sequences
        sequences.add(r.sequence_id)
        rows[r.doc_id].append(r)
    for doc_id, text in texts_of(spark, small_dir).items():
        ids = np.array(whole.encode(text, add_special_tokens=False).ids + [1], "<u4").tobytes()
        at = 0
        for r in sorted(rows.pop(doc_id), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids) // 4)
            assert zlib.crc32(ids[4 * at : 4 * (at + r.length)]) == r.ids_crc32
            at += r.length
        assert at == len(ids) // 4
    assert not rows


def test_packing_odd_rows(odd, none):
    rows = packing.pack(odd, BPE, longest=8).collect()
    assert sum(r.length for r in rows if r.doc_id == 3) == 1
    assert sorted(r.doc_tokens for r in rows if r.doc_id == 4) == [1]
    whole = Tokenizer.from_file(BPE)
    for text in ("A<|endoftext|>B c.", "I'm here!! 'S WHAT?", "ΑΣ ΣΑΣ. İx", TEXTS[7][1]):
        ids = whole.encode(text, add_special_tokens=False).ids
        assert packing.WordIds(BPE).of(text) == np.array(ids, "<u4").tobytes()
    assert packing.pack(none, BPE).count() == 0
    assert packing.piece_lengths(21, 8) == [8, 8, 4, 1]
    with pytest.raises(ValueError):
        packing.pack(odd, BPE, longest=6)


# ---- classifiers


def held_out_rows(spark, name, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    marks = common.load(spark, sf_dir, "labels")
    rows = LLM_QUERIES[name](spark, sf_dir).join(marks, "doc_id").where("held_out").collect()
    assert all(0 <= r.score <= 1 for r in rows)
    return rows


def test_held_out_quality(spark):
    rows = held_out_rows(spark, "op2_quality_classifier", "0.01")
    low = [r for r in rows if r.quality == 0]
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.93
    assert low and np.mean([r.predicted == 0 for r in low]) > 0.5


def test_held_out_toxicity(spark):
    """Neither 'always clean' nor 'always toxic' passes."""
    rows = held_out_rows(spark, "op8_toxicity", "0.1")
    toxic = [r.predicted for r in rows if r.toxic == 1]
    clean = [r.predicted for r in rows if r.toxic == 0]
    assert len(toxic) > 100 and np.mean(toxic) > 0.85
    assert np.mean(clean) < 0.02


def test_best_cutoff():
    scores = np.array([0.1, 0.2, 0.4, 0.6, 0.9])
    cut = toxicity.best_cutoff(scores, np.array([0, 0, 0, 1, 1]))
    assert 0.4 < cut < 0.5
    assert 0.6 < toxicity.best_cutoff(scores, np.array([0, 1, 0, 0, 1])) < 0.7
    assert toxicity.best_cutoff(np.array([0.5, 0.5]), np.array([0, 1])) not in (0, 1)


def test_quality_scores_do_not_shift_with_the_bound(spark):
    rows = [(i, f"some words about nothing {i % 7}", int(i % 10 != 0)) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    means = []
    for bound in (200, 5000):
        model = quality_classifier.fit(docs.select("doc_id", "text"), docs.select("doc_id", "quality"), bound=bound)
        means.append(quality_classifier.with_score(docs, model, name="own").agg(F.avg("own")).first()[0])
    assert all(abs(m - 0.9) < 0.04 for m in means), means


def test_learnt_rows_do_not_depend_on_layout_or_absent_ids(spark):
    """Of rows with one id always the same is learnt; labels of ids without a text take no place."""
    marks = spark.createDataFrame([(i, i % 2) for i in range(4000)], "doc_id long, quality int")
    rows = [(i, t) for i in range(3000, 3100) for t in ("B", "A", None, f"own {i}")]
    found = []
    for parts in (1, 2, 7):
        docs = spark.createDataFrame(rows[::-1] if parts == 2 else rows, "doc_id long, text string").repartition(parts)
        learnt = labelled.training_rows(docs, marks, "quality", 20).collect()
        found.append(sorted((r.doc_id, r.text or "", r.label) for r in learnt))
    assert found[0] == found[1] == found[2]
    assert collections.Counter(label for _, _, label in found[0]) == {0: 20, 1: 20}
    assert all(3000 <= i < 3100 and zlib.crc32(str(i).encode()) % 4 != 2 for i, _, _ in found[0])
    assert labelled.log_odds_shift(docs, marks.where("doc_id < 3000"), "quality", 5) == 0


def test_factorisation_identity():
    model = quality_classifier.FactorisationMachine(50, seed=3)
    model.w = np.random.default_rng(1).normal(size=50)
    index, value = np.array([3, 9, 20, 41]), np.array([0.5, 1.0, -2.0, 0.3])
    pairs = sum(
        model.v[a] @ model.v[b] * x * y
        for i, (a, x) in enumerate(zip(index, value))
        for b, y in list(zip(index, value))[i + 1 :]
    )
    assert model.logit(index, value) == pytest.approx(model.bias + model.w[index] @ value + pairs)


def test_classifiers_odd_rows(spark, odd, none, labels):
    no_labels = labels.limit(0)
    for known in (labels, no_labels):
        model = quality_classifier.fit(odd, known, ["n_chars"])
        scored = quality_classifier.with_score(odd, model, ["n_chars"], name="own").collect()
        assert len(scored) == len(TEXTS) and all(0 <= r.own <= 1 for r in scored)
        network = toxicity.fit(odd, known)
        scored = toxicity.with_score(odd, network, name="own").collect()
        assert len(scored) == len(TEXTS) and all(0 <= r.own <= 1 for r in scored)
    assert quality_classifier.with_score(none, model, ["n_chars"], name="own").count() == 0
    assert toxicity.with_score(none, network, name="own").count() == 0


def test_toxicity_learns_from_every_window(spark, monkeypatch):
    """Tasks judge all windows of a text but those of very many characters."""
    monkeypatch.setattr(toxicity, "HARD", 10_000)
    words = [f"w{i}" for i in range(2000)]
    rows = [(i, " ".join(words if i else words + ["x" * 3000]), i % 2) for i in range(4)] + [(4, None, 0), (5, "y" * 3000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    found = toxicity.picked(docs, "text", lambda label, windows: range(len(windows)))
    want = sorted(words[a : a + toxicity.LENGTH] for a in toxicity.window_starts(len(words)))
    assert sorted(found[1]) == sorted(2 * want + [[]])
    assert sorted(w for w in found[0] if w and w in want) == sorted(2 * want) and [] in found[0]
    counts = toxicity.word_counts(docs, "text")
    assert set(counts) == set(words) and set(counts.values()) == {(2, 2)}


def test_network_gradients():
    network = toxicity.Network(["a", "b"], seed=5)
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    toxicity.f32, kept = np.float64, toxicity.f32
    try:
        rng = np.random.default_rng(0)
        gates, mask = rng.normal(size=(3, 5, 6 * toxicity.HIDDEN)), np.ones((3, 5))
        mask[1, 3:] = 0
        keep = {}
        network.forward(gates, mask, keep)
        error = rng.normal(size=3)
        grad, dgates = network.backward(keep, mask, error)

        def loss():
            return float(error @ network.forward(gates, mask))

        for name in ("hf", "hb", "aw", "av", "o"):
            flat, at = network.p[name].reshape(-1), 3
            flat[at] += 1e-5
            up = loss()
            flat[at] -= 2e-5
            assert grad[name].reshape(-1)[at] == pytest.approx((up - loss()) / 2e-5, rel=1e-4, abs=1e-7)
            flat[at] += 1e-5
        gates[0, 2, 7] += 1e-5
        up = loss()
        gates[0, 2, 7] -= 2e-5
        assert dgates[0, 2, 7] == pytest.approx((up - loss()) / 2e-5, rel=1e-4, abs=1e-7)
    finally:
        toxicity.f32 = kept


# ---- licences and token counts


def test_license_scan(spark, odd, none):
    known = license_scan.known_texts(spark)
    rows = [
        (1, "Copyright 2020 Someone\nreleased UNDER the mit licence"),
        (2, "x\nReleased under the MIT License.\ny"),
        (3, "Released under the MIT License, perhaps."),
        (4, license_scan.KNOWN[7][1].upper()),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(map(tuple, license_scan.scan(docs, known).collect()))
    assert found == [(1, "line", 2, "MIT"), (1, "text", 0, "MIT"), (2, "line", 2, "MIT"), (4, "text", 0, "MIT")]
    assert license_scan.scan(docs, known, broadcast_rows=0).count() == len(found)
    assert license_scan.scan(odd, known).count() == license_scan.scan(none, known).count() == 0


def wrapped(text, width):
    """``text`` wrapped anew, its first line (the copyright notice) and paragraphs kept."""
    first, *rest = text.split("\n\n")
    return "\n\n".join([first, *(textwrap.fill(p, width, break_on_hyphens=False) for p in rest)])


ISC = """Copyright (c) 2004-2010 by Internet Systems Consortium, Inc. ("ISC")

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""
MIT = """Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""


def test_licenses_match_at_every_wrap_width(spark):
    texts = [(name, w, wrapped(text, w)) for name, text in (("ISC", ISC), ("MIT", MIT)) for w in (20, 40, 60, 72, 76, 78, 80, 100, 999)]
    texts += [("ISC", 0, ISC), ("MIT", 0, MIT), ("MIT", 1, MIT.replace("(c) 2020 Someone", "OpenJS Foundation and other contributors"))]
    docs = spark.createDataFrame([(i, x[2]) for i, x in enumerate(texts)], "doc_id long, text string")
    found = license_scan.scan(docs, license_scan.known_texts(spark)).where("line = 0").collect()
    assert sorted((r.doc_id, r.license) for r in found) == [(i, x[0]) for i, x in enumerate(texts)]
    lines = ["(c) You must retain, in the Source form", "copyright license to reproduce", "All rights reserved and more"]
    kept = spark.createDataFrame([(x,) for x in lines], "text string").select(license_scan.canonical(F.col("text")))
    assert all(r[0] for r in kept.collect())


def test_usual_licenses_are_known(spark):
    folder = pathlib.Path(license_scan.__file__).parent / "licenses"
    gpl = (folder / "GPL-3.0.txt").read_text()
    apache = (folder / "Apache-2.0.txt").read_text()
    rows = [
        ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
        ("MPL-2.0", "# SPDX-License-Identifier: MPL-2.0"),
        ("BSD-3-Clause", "This project is licensed under the BSD 3-Clause License."),
        ("GPL-3.0-or-later", "Licensed under the GNU General Public License, version 3 or later"),
        ("CC-BY-SA-3.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License."),
        ("MIT", "MIT License\n\n" + MIT),
        ("MIT", "The MIT License (MIT)\n\n" + wrapped(MIT, 60)),
        ("ISC", "ISC License\n\n" + ISC),
        ("GPL-3.0", gpl),
        ("GPL-3.0", gpl.replace("https://", "http://")),
        ("GPL-3.0", gpl[: gpl.index("How to Apply")]),
        ("Apache-2.0", apache.replace("[yyyy] [name of copyright owner]", "2019 Someone")),
        ("Apache-2.0", apache[apache.index("TERMS AND") : apache.index("APPENDIX")]),
    ]
    rows += [(f.name.removesuffix(".txt").removesuffix(".2"), f.read_text()) for f in sorted(folder.iterdir())]
    docs = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(rows)], "doc_id long, text string")
    found = license_scan.scan(docs, license_scan.known_texts(spark)).where("line = 0").collect()
    assert sorted((r.doc_id, r.license) for r in found) == [(i, name) for i, (name, _) in enumerate(rows)]


def best_count(scores, word):
    marked = token_counts.SPACE + word
    least = min(scores.values())
    best = [(0.0, 0)]
    for end in range(1, len(marked) + 1):
        options = [
            (best[a][0] + scores[marked[a:end]], best[a][1] - 1) for a in range(end) if marked[a:end] in scores
        ]
        if marked[end - 1] not in scores:
            n = len(marked[end - 1].encode())
            options.append((best[end - 1][0] + n * least, best[end - 1][1] - n))
        best.append(max(options))
    return -best[-1][1]


def test_token_counts(spark, small_dir, odd, none):
    scores = token_counts.zipf_scores(PIECES)
    texts = texts_of(spark, small_dir)
    rows = LLM_QUERIES["op4_token_counts"](spark, small_dir).where("doc_id < 40").collect()
    known = {}
    for r in rows:
        words = (texts[r.doc_id] or "").split()
        for w in words:
            known.setdefault(w, None)
        for w in [w for w in words if known[w] is None]:
            known[w] = best_count(scores, w)
        assert (r.n_words, r.n_tokens) == (len(words), sum(known[w] for w in words))
    rare = ["<0x41>", "\U0001f98b", "a\u4e00\U0001f98bb", "e" * 40]
    assert "<0x41>" not in scores and "e" in scores
    trie = token_counts.CountTrie(scores)
    assert [trie[w] for w in rare] == [best_count(scores, w) for w in rare]
    small = token_counts.CountTrie(scores, limit=50)
    assert [small[w] for w in list(known)[:200]] == [known[w] for w in list(known)[:200]]
    counted = {(r.doc_id, r.text): r.own for r in token_counts.with_counts(odd, PIECES, name="own").collect()}
    assert counted[(3, None)] == counted[(4, "")] == counted[(5, " \t\n ")] == 0
    assert token_counts.with_counts(none, PIECES, name="own").count() == 0


# ---- quality rules


def binomial(n, k, p):
    from math import comb

    return sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def test_binomial_tail(spark):
    cases = [(10, 0), (50, 1), (1000, 3), (700, 0), (5000, 30), (90, 89)]
    frame = spark.createDataFrame(cases, "n long, k long")
    for r in frame.withColumn("p", quality_rules.binomial_tail(F.col("n"), F.col("k"), 0.0125)).collect():
        want = binomial(r.n, r.k, 0.0125) if r.k < r.n * 0.0125 else 1.0
        assert r.p == pytest.approx(want, rel=1e-9)


def test_rules_choose_the_lowest_safe_cutoff(spark):
    rows, marks = [], []
    for i in range(2000):
        words = " ".join(f"w{(i * 31 + j * 7) % 5003}" for j in range(30))
        rows.append((i, words + (" | | | | |" if i % 100 == 0 else "")))
        marks.append((i, 1))
    rows += [(10_000, "X" * 3 + " " + " ".join(f"a{j} |" for j in range(15))), (10_001, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    counted = quality_rules.with_statistics(docs)
    table = {r.stratum: r for r in quality_rules.cutoffs(counted, labels, alpha=0.2).collect()}
    # one in a hundred good texts has 5 symbols in 35 words: a share of 1/7 must be spared at 1 % but not at 5 %
    assert table[0].n == 2000 and table[0].symbols == 0.02 and table[0].capitals == 0.02
    strict = {r.stratum: r for r in quality_rules.cutoffs(counted, labels, alpha=0.02).collect()}
    assert strict[0].symbols == 0.15
    kept = {r.doc_id for r in quality_rules.keep_good(docs, labels, alpha=0.02).collect()}
    assert kept == set(range(2000))


def test_rules_odd_rows(odd, none, labels):
    kept = quality_rules.keep_good(odd, labels)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 2, 6]
    assert quality_rules.keep_good(none, labels).count() == 0
    assert quality_rules.keep_good(odd, labels.limit(0)).count() == 4


# ---- sharding


def test_shards(spark, small_dir, odd, none):
    rows = LLM_QUERIES["op6_sharding"](spark, small_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts_of(spark, small_dir))
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert sorted(slots) == list(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    order = [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert order != sorted(order)
    few = sharding.shard(odd, 5, bucket_bytes=1000).collect()
    assert len(few) == len(TEXTS) and few[0].record.asDict().keys() == set(odd.columns)
    assert collections.Counter(r.shard for r in few) == {0: 3, 1: 3, 2: 2, 3: 2, 4: 2}
    assert sharding.shard(odd, 40).count() == len(TEXTS)
    # A file for every bucket that has rows: none shares a task with another.
    assert len(sharding.shuffled_buckets(spark.range(2000), 1, 50).inputFiles()) == 50
    assert sharding.shard(none, 5).count() == 0


# ---- repeated passages


def brute_repeats(docs):
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - repeats.SPAN + 1):
            window = data[i : i + repeats.SPAN]
            if window in seen:
                gone[i : i + repeats.SPAN] = b"\x01" * repeats.SPAN
            else:
                seen.add(window)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(data, gone) if not g)
        out[doc_id] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def test_repeats_equal_brute_force(spark, small_dir):
    want = brute_repeats(texts_of(spark, small_dir).items())
    rows = LLM_QUERIES["op7_suffix_array"](spark, small_dir).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == want


@pytest.mark.parametrize("hot", [repeats.HOT, 2])
def test_repeats_of_edited_copies(spark, hot):
    rng = random.Random(5)
    base = " ".join(rng.choice(["alpha", "beta", "gamma", "délta", "x"]) + str(rng.randrange(50)) for _ in range(150))
    docs = []
    for i in range(60):
        text = list(base)
        for _ in range(rng.randrange(6)):
            text[rng.randrange(len(text))] = rng.choice("qz")
        cut = rng.randrange(len(text))
        docs.append((i, "".join(text[cut:] + text[:cut]) if i % 3 else "ab" * rng.randrange(300)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = repeats.remove_repeats(frame, hot=hot).collect()
    got = {
        r.record.doc_id: (r.n_bytes, r.n_bytes - len(r.kept), len(r.removed), hashlib.sha256(r.kept).hexdigest())
        for r in rows
    }
    assert got == brute_repeats(docs)


def brute_groups(docs):
    """(bytes, anchor's place in them) -> occurrences, from all strings around equal anchors."""
    places = collections.defaultdict(list)
    for n, (doc_id, text) in enumerate(docs):
        data = (text or "").encode()
        if len(data) >= repeats.SPAN:
            for place, value in zip(*repeats.anchors(np.frombuffer(data, np.uint8))):
                if place + repeats.GRAM <= len(data):
                    places[int(value)].append((n, int(place)))
    data = [(t or "").encode() for _, t in docs]
    found = collections.defaultdict(set)
    for same in places.values():
        if len(same) < 2:
            continue
        strings = collections.defaultdict(set)
        for n, p in same:
            for back in range(min(p, repeats.BEFORE) + 1):
                for ahead in range(1, min(len(data[n]) - p, repeats.SPAN) + 1):
                    strings[back, data[n][p - back : p + ahead]].add((n, p))
        for (back, string), members in strings.items():
            if len(members) < 2 or len(string) < repeats.SPAN:
                continue

            def goes_on(step):
                """All members have the same further byte on that side, within the bounds."""
                if step < 0:
                    more = {data[n][p - back - 1] if p > back and back < repeats.BEFORE else (n, p) for n, p in members}
                else:
                    ahead = len(string) - back
                    more = {data[n][p + ahead] if p + ahead < len(data[n]) and ahead < repeats.SPAN else (n, p) for n, p in members}
                return len(more) == 1

            if not goes_on(-1) and not goes_on(1):
                found[back, string] |= {(docs[n][0], p - back) for n, p in members}
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_have_all_occurrences(spark, seed):
    """Groups equal brute force: edited copies, whole copies, texts that begin and end with the passage, rows without one."""
    rng = random.Random(seed)
    word = lambda: rng.choice(["alpha", "beta", "gamma", "délta", "x"]) + str(rng.randrange(30))
    passage = " ".join(word() for _ in range(24))
    docs = [(0, passage), (1, f"{word()} {passage}"), (2, f"{passage} {word()}"), (3, None), (4, "short"), (5, passage[20:])]
    for i in range(6, 14):
        text = list(f"{' '.join(word() for _ in range(12))} {passage} {' '.join(word() for _ in range(12))}")
        for _ in range(rng.randrange(3)):
            text[rng.randrange(len(text))] = "q"
        docs.append((i, "".join(text)))
    docs.append((14, docs[7][1]))
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, digest string").repartition(3)
    got = collections.defaultdict(set)
    for r in repeats.repeat_groups(frame).collect():
        assert (r.doc_id, r.start) not in got[r.group, r.length]
        got[r.group, r.length].add((r.doc_id, r.start))
    want = brute_groups(docs)
    assert len(want) > 5
    texts = dict(docs)
    named = collections.Counter()
    for (_, length), members in got.items():
        strings = {texts[d].encode()[s : s + length] for d, s in members}
        assert len(strings) == 1
        named[strings.pop(), frozenset(members)] += 1
    assert named == collections.Counter((string, frozenset(members)) for (_, string), members in want.items())


def test_groups_of_odd_rows(odd, none):
    rows = repeats.repeat_groups(odd).collect()
    assert {r.doc_id for r in rows} == {1, 2} and all(r.length >= repeats.SPAN and r.start >= 0 for r in rows)
    sizes = collections.Counter(r.group for r in rows)
    assert set(sizes.values()) == {3}
    assert repeats.repeat_groups(none).count() == 0


def test_prefixes_and_intervals():
    assert list(repeats.intervals([1, 3, 2])) == [(3, 1, 2), (2, 1, 3), (1, 0, 3)]
    assert repeats.prefix(b"abc", b"abd") == 2 and repeats.prefix(b"ab\0", b"ab\0") == 2


def test_runs_of_one_byte_stay_small():
    size = 400_000
    docs = pa.table({"p": [0], "row": [0], "order": [1], "text": ["-" * size], "record": [None]})
    hashes = repeats.send_hashes(docs, 1)
    repeated = repeats.find_repeated(hashes, 100_000)
    tracemalloc.start()
    entries = repeats.send_contexts(docs, repeated, 1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400 * size
    done = repeats.cut(docs, repeats.scan_suffixes(entries)).to_pylist()[0]
    assert done["removed"] == [{"start": 1, "end": size}]
    places = np.array([3, 4, 70, 200])
    want = sorted({p - k for p in places.tolist() for k in range(69) if p >= k})
    assert repeats.up_to(places, 68).tolist() == want


def test_repeats_odd_rows(odd, none):
    short = repeats.without_repeats(odd)
    assert short.columns == odd.columns
    rows = short.collect()
    assert len(rows) == len(TEXTS)
    assert sorted(r.text for r in rows if r.doc_id == 2) == ["", ""]
    assert [r.text for r in rows if r.doc_id in (1, 3, 4, 7)].count("") == 2
    assert repeats.without_repeats(none).count() == 0


# ---- decontamination


def test_bands_miss_nothing_that_matters():
    for ratio in range(-4, 8):
        rows = decontamination.rows_per_band(ratio, 0.8)
        assert rows == 0 if ratio < -1 else rows == -1 if ratio > 0 else rows > 0


def test_decontamination(spark, odd, none):
    rng = random.Random(2)
    words = [f"t{i}" for i in range(3000)]
    items = [(i, " ".join(rng.sample(words, 30))) for i in range(12)] + [(50, "too short item"), (51, None), (None, "")]
    filler = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs = [(0, f"{filler(900)} {items[3][1].upper()}! {filler(4000)}"), (1, filler(500))]
    docs.append((2, " ".join(t for _, t in items[:12])))  # many items at once: no banding reaches them
    docs.append((3, " ".join(items[5][1].split()[:15])))  # half an item
    docs.append((4, " ".join(items[6][1].split()[:27])))
    docs += [(5, docs[0][1]), (5, docs[0][1]), (None, None), (7, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in decontamination.matches(frame, bench).collect())
    assert got == sorted([(0, 3), (5, 3), (5, 3), (4, 6)] + [(2, i) for i in range(12)])
    kept = decontamination.drop_contaminated(frame, bench).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == [(False, 1), (False, 3), (False, 7), (True, 0)]
    assert decontamination.drop_contaminated(odd, bench).collect().__len__() == len(TEXTS)
    assert decontamination.drop_contaminated(none, bench).count() == 0
    assert decontamination.matches(frame, bench.limit(0)).count() == 0


def test_a_common_phrase_is_no_candidate(spark, monkeypatch):
    """A phrase in every item and document adds no pairs, and no match is lost for it."""
    rng = random.Random(3)
    words = [f"t{i}" for i in range(20_000)]
    phrase = "answer the following question in full"
    items = [(i, f"{phrase} " + " ".join(rng.sample(words, 20))) for i in range(60)]
    docs = [(i, f"{phrase} " + " ".join(rng.sample(words, 30)) + (" " + items[i % 60][1] + " " + items[(i + 1) % 60][1] if i % 4 == 0 else "")) for i in range(200)]
    found = []
    monkeypatch.setattr(decontamination, "frozen", lambda df, prefix: found.append((prefix, common.frozen(df, prefix))) or found[-1][1])
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.matches(frame, bench).collect()}
    assert got == {(i, k) for i in range(0, 200, 4) for k in (i % 60, (i + 1) % 60)}
    rows = dict(found)["benchmark-rows"]
    common_shingles = rows.groupBy("h").count().where("count = 60").select("h")
    assert common_shingles.count() == 2
    assert rows.where("key").join(common_shingles, "h").count() == 0
    keys = {r["count"] for r in rows.where("key").groupBy("item").count().collect()}
    assert keys == {22 - 18 + 1}


# ---- SimHash


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, budget=2):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= budget:
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return [find(i) for i in range(len(prints))]


def test_simhash_equals_brute_force(spark, small_dir):
    texts = texts_of(spark, small_dir)
    ids = sorted(texts)
    prints = [brute_fingerprint(texts[i]) for i in ids]
    want = {i: (f"{p:016x}", ids[c]) for i, p, c in zip(ids, prints, brute_components(prints))}
    rows = LLM_QUERIES["op10_simhash"](spark, small_dir).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == want


@pytest.mark.parametrize("subtree, crowded", [(4, 50_000), (8, 20)])
def test_trie_join_finds_crowded_links(spark, subtree, crowded):
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    prints = {centre ^ sum(1 << b for b in rng.sample(range(64), 3)) for _ in range(120)}
    prints |= {rng.getrandbits(64) for _ in range(120)} | {0, 1, (1 << 64) - 1, (1 << 63) | 1}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(s,) for s in signed], "fingerprint long")
    edges = simhash.links(frame, 2, subtree, crowded)
    roots = {r.u: r.root for r in common.components(edges, "test-links").collect()}
    groups = collections.defaultdict(set)
    for p, s in zip(prints, signed):
        groups[roots.get(s, s)].add(p)
    want = collections.defaultdict(set)
    for p, c in zip(prints, brute_components(prints)):
        want[c].add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_simhash_keeps_one(odd, none):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    # rows without words share fingerprint 0; equal texts and repeated rows are one
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [
        (False, 1), (False, 3), (False, 6), (False, 7), (False, 9), (False, 9), (True, 0)
    ]
    assert simhash.keep_one(none).count() == 0
    table = common.frozen(odd, "test-written")
    assert sorted(map(str, simhash.keep_one(table, written=True).collect())) == sorted(
        map(str, simhash.keep_one(table).collect())
    )
    assert simhash.keep_one(common.frozen(none, "test-written"), written=True).count() == 0


def test_words_equal_whole_texts(spark, small_dir):
    words, whole = packing.WordIds(BPE), Tokenizer.from_file(BPE)
    texts = [t or "" for t in texts_of(spark, small_dir).values()] + ["it's don't x's", "naïve COBÁN, a!b?", "zz" * 300]
    assert words.plain
    for text in texts:
        assert np.frombuffer(words.of(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_words_keep_runs_of_symbols():
    words, whole = packing.WordIds(BPE), Tokenizer.from_file(BPE)
    texts = ['(foo). "hello", f(x); [1], **note**: done". {};', '329B"!! a\u0301. \u0130. X\u0130! a\u037e. \u00bd, \u3042.', "(FOO). 'S. ...a..."]
    for text in texts:
        assert np.frombuffer(words.of(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


# ---- pipeline


def test_pipeline_stages_equal_brute_force(spark, small_dir):
    docs = common.load(spark, small_dir, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = common.frozen(stage(spark, docs, small_dir), "test-stage")
        if name == "packing":
            assert {r.doc_id for r in docs.collect()} == set(before)
            continue
        assert docs.columns == columns
        after = {r.doc_id: r.text for r in docs.collect()}
        if name == "simhash":
            ids = sorted(before)
            roots = brute_components([brute_fingerprint(before[i]) for i in ids])
            assert set(after) == {ids[c] for c in roots}
        elif name == "suffix_array":
            want = brute_repeats(before.items())
            assert set(after) == set(before)
            assert all(len(after[i].encode()) <= want[i][0] - want[i][1] for i in after)
        else:
            assert set(after) < set(before)
            assert all(after[i] == before[i] for i in after)


def test_pipeline_odd_tables(spark, odd, none, small_dir):
    for start in (odd, none):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = common.frozen(stage(spark, docs, small_dir), f"odd-{name}")
            if name != "packing":
                assert docs.columns == start.columns
