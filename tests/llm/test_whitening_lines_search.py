"""Whitening, line deduplication and ranked search against brute force, on small tables with odd rows."""

import hashlib
import math
import re

import numpy as np
import pytest

from reelhouse.llm import lexical, line_dedup, whitening
from test_llm import frame, odd_rows, words

WHITE = " \t\n\v\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "label", "x") for i, v in rows], "vec_id long, embedding array<double>, row string, values string")


def plain_whitening(rows, components):
    kept = [(i, np.floor(1024 * np.array(v)).astype(object) + 100000) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    n, s = len(kept), sum(x for _, x in kept)
    centred = np.array([[float(int(n * c - t)) / n for c, t in zip(x, s, strict=True)] for _, x in kept])
    covariance = centred.T @ centred / n
    values, directions = np.linalg.eigh(covariance)
    best = np.argsort(-values)[:components]
    return kept, [int(sum((n * c - t) ** 2 for c, t in zip(x, s, strict=True))) for _, x in kept], centred @ directions[:, best] / np.sqrt(values[best]), values[best] / np.trace(covariance)


def test_whitening(spark, monkeypatch):
    draw = np.random.default_rng(3)
    rows = [(i, (draw.standard_normal(6) * [5, 4, 3, 2, 1, 0.5] + 7).tolist()) for i in range(300)]
    rows += [(rows[0][0], rows[0][1]), (None, rows[1][1]), (900, rows[2][1])]  # repeated, without an id, an equal vector
    rows += [(901, None), (902, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (903, [math.nan] * 6), (904, [math.inf] + [0.0] * 5), (905, []), (906, [1e300] + [0.0] * 5)]
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 16)  # many blocks
    got = whitening.whitened(vectors(spark, rows).repartition(5), components=4).collect()
    kept, deviation, projected, explained = plain_whitening(rows[:-1], 4)
    assert len(got) == 4 * len(kept) and {r.n for r in got} == {len(kept)} and {r.component for r in got} == {1, 2, 3, 4}
    want = {}
    for (i, _), d, p in zip(kept, deviation, projected, strict=True):
        want.setdefault(i, (d, p))
    sign = {}
    for r in sorted(got, key=lambda r: -abs(r.whitened)):
        d, p = want[r.vec_id]
        s = sign.setdefault(r.component, np.sign(r.whitened * p[r.component - 1]))
        assert int(r.deviation) == d
        assert r.whitened * s == pytest.approx(p[r.component - 1], abs=1e-9)
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        assert r.identity_error < 1e-9


def test_whitening_without_variance(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)], [(1, [])]):
        assert whitening.whitened(vectors(spark, rows)).collect() == []
    flat = whitening.whitened(vectors(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0]), (3, [5.0])])).collect()  # one direction; another length
    assert {(r.vec_id, r.component, round(abs(r.whitened), 9), r.n) for r in flat} == {(1, 1, 1.0, 2), (2, 1, 1.0, 2)}


def line_rows():
    rows = [(100 + i, f"{' '.join(words(i, 6))}\n  Common LINE {i % 3}\t\n\n{'Shared by two' if i < 2 else i}\nÉ É ", "s") for i in range(24)]
    rows += [(200, "common line 0\ncommon line 0\nCOMMON LINE 0", "s"), (201, "\n\n", None), (202, " common line 1\r\nlast\r", "s")]
    return odd_rows() + rows + [rows[5], (None, rows[6][1], "s")]  # a repeated row, and one without an id


def plain_lines(rows, least_docs, least_chars, keep_first):
    keys = lambda t: [line.strip(WHITE).translate(LOWER) for line in (t or "").split("\n")]
    docs = {}
    for n, (_, text, _) in enumerate(rows):
        for k in set(keys(text)):
            docs.setdefault(k, set()).add(n)
    often = {k for k, d in docs.items() if len(k) >= least_chars and len(d) >= least_docs}
    owner = {k: min(((rows[n][0] is None, rows[n][0] or 0), n) for n in docs[k]) for k in often}
    out = []
    for n, (doc_id, text, _) in enumerate(rows):
        lines, kept, met = (text or "").split("\n"), [], set()
        for line, k in zip(lines, keys(text), strict=True):
            own = keep_first and k in owner and owner[k][0] == (doc_id is None, doc_id or 0) and rows[owner[k][1]][1] == text
            if k not in often or (own and k not in met):
                kept.append(line)
            met.add(k)
        out.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sent, bits", [(1 << 19, 1 << 28), (0, 1 << 28), (1 << 19, 1 << 16)])
@pytest.mark.parametrize("least_docs, least_chars, keep_first", [(10, 1, False), (2, 3, False), (2, 1, True)])
def test_line_counts(spark, monkeypatch, sent, bits, least_docs, least_chars, keep_first):
    monkeypatch.setattr(line_dedup, "SENT_KEYS", sent)  # 0: keys are joined to their documents
    monkeypatch.setattr(line_dedup, "MOST_BITS", bits)
    rows = [r for r in line_rows() if not (keep_first and r[0] is None)]  # rows without an id have no order among themselves
    got = line_dedup.line_counts(frame(spark, rows).repartition(7), least_docs, least_chars, keep_first).collect()
    assert sorted(map(tuple, got), key=repr) == plain_lines(rows, least_docs, least_chars, keep_first)


def test_lines_cut_from_rows(spark):
    docs = frame(spark, line_rows())
    cut = line_dedup.without_frequent_lines(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    assert {r.text for r in cut.collect() if r.doc_id == 4} == {None} and "common line 0" not in "".join(r.text or "" for r in cut.collect()).lower()
    none = spark.createDataFrame([], docs.schema)
    assert line_dedup.line_counts(none).collect() == [] and line_dedup.without_frequent_lines(none).collect() == []


def test_filter_misses_no_repeat(spark):
    docs = frame(spark, [(i, f"line {i // 2}\nown {i}", "s") for i in range(4000)]).repartition(9)
    found = line_dedup.line_digests(docs, 1)
    twice = line_dedup.seen_twice(found, 1 << 17)
    named = {bytes(r.digest) for r in line_dedup.suspects(found, twice).select("digest").distinct().collect()}
    assert {line_dedup.digest_of(f"line {i}".encode()) for i in range(2000)} <= named
    assert len(named) < 2000 + 400  # of 4000 single lines few are suspected


def plain_search(docs, items, k):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    docs = [(d, terms(t)) for d, t, *_ in docs]
    n_docs, length, df = sum(bool(t) for _, t in docs), sum(len(t) for _, t in docs), {}
    for _, t in docs:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in dict.fromkeys(items):
        scores = []
        for d, t in docs:
            if t:
                m = 10 + (90 * len(t) * n_docs) // length
                score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((10**9 * t.count(x)) // (1000 * t.count(x) + 8 * m)) for x in set(terms(text)) if x in t)
                if score > 0:
                    scores.append((-score, d is None, d))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block, shard", [(48, 4096), (4, 32), (1, 64)])
def test_search(spark, monkeypatch, block, shard):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block)
    monkeypatch.setattr(lexical, "SHARD_DOCS", shard)
    monkeypatch.setattr(lexical, "WAVE", 2)
    docs = odd_rows() + [(1000 + i, " ".join(words(i % 150, 5 + i % 40)), "s") for i in range(400)] + [(3000 + i, "The exact same copy, of Été 3", "s") for i in range(60)]
    items = [(1, " ".join(words(3, 12))), (2, "the SAME copy"), (3, None), (4, "!? --"), (5, "été unknownterm"), (6, "one two three"), (7, " ".join(words(1, 300))), (None, "copy"), (2, "the SAME copy")]
    table = spark.createDataFrame([(i, t, "r") for i, t in items], "item_id long, text string, rank string")
    got = lexical.search(frame(spark, docs).repartition(6), table).collect()
    assert sorted(map(tuple, got), key=repr) == plain_search(docs, items, 10)


def test_search_of_nothing(spark):
    docs, none = frame(spark, odd_rows()), frame(spark, [])
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert lexical.search(none, items).collect() == []
    assert lexical.search(docs, items.limit(0)).collect() == []
    assert lexical.search(frame(spark, [(1, None, "s"), (2, " ", "s")]), items).collect() == []


def test_blocks_are_passed_over():
    """With a threshold, most blocks of a common term's list are passed over, and nothing is lost by it."""
    import pandas as pd

    draw = np.random.default_rng(1)
    rows = [(i, 50, sorted({0} | set(draw.integers(1, 40, 3).tolist()))) for i in range(2000)]
    frame_ = pd.DataFrame([(r, r, n, t, [1] * len(t), 0) for r, n, t in rows], columns=["row", "doc_id", "n", "terms", "times", "shard"])
    weights = np.array([100] + [5000] * 39, np.int64)
    order = np.argsort(-weights, kind="stable")
    place = {int(o): i for i, o in enumerate(order)}
    frame_["terms"] = [[place[t] for t in ts] for ts in frame_["terms"]]
    asked = lexical.Asked([[place[0], place[1], place[2]]], weights[order], 2000, 100_000, 48)
    lists = lexical.blocks_of(asked, frame_)
    open_ = lexical.searched(asked, np.zeros(1, np.int64), 10, frame_, lists)
    floor = int(open_["score"].min())
    again = lexical.searched(asked, np.array([floor]), 10, frame_, lists)
    assert again.values.tolist() == open_.values.tolist()
    common = lists[lists["term"] == place[0]].iloc[0]
    summary = np.frombuffer(common["summary"], np.int64).reshape(-1, 1)
    assert (summary.sum(axis=1) < floor).all()
