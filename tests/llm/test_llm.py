"""The pipeline operators against brute force, exact round trips and held-out accuracy, on small tables with odd rows."""

import hashlib
import itertools
import os
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
import xxhash

from reelhouse import session
from reelhouse.llm import exact_dedup, licenses, mixing, neighbours, packing, quality, simhash, substring_dedup, token_counts, token_store, tokens

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"
SCHEMA = "doc_id long, text string, source string, run string, digest string, size string, fp string"  # clashing names


def words(seed, n):
    draw = random.Random(seed)
    return [draw.choice("abcdefghij") + draw.choice(["on", "er", "ith", "alo", "une"]) + draw.choice(["", "s", "ed", "ment"]) for _ in range(n)]


def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows, white space that does and doesn't count."""
    long = " ".join(words(1, 9000))
    return [
        (1, "One  two three", "a"), (2, "One two\tthree", "a"), (3, "Onetwothree", "b"), (3, "Onetwothree", "b"),
        (4, None, "b"), (5, "", None), (6, " \n", None), (None, "One two three ", "a"), (None, "no id", None),
        (7, long, "a"), (8, long, "c"), (9, long + " end", "c"), (10, "é x É", "é"), (11, "x" * 70_000, "c"), (12, "a b", "b"),
    ]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "f") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, odd_rows())


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    files = spark.createDataFrame([], "file_id long, path string, text string")
    model = quality.learn(empty, labels)
    for df in (
        substring_dedup.repeated_spans(empty), neighbours.nearest(vectors), mixing.mix(empty), mixing.mixed(empty), simhash.near_duplicates(empty),
        simhash.one_of_each(empty), packing.packed(empty, BYTE_BPE), token_store.stored(empty, WORD_BPE), quality.scored(empty, model),
        quality.good_ones(empty, model), token_counts.token_counts(empty, BYTE_BPE), licenses.scan(files), exact_dedup.exact_dedup(empty), exact_dedup.without_copies(empty),
    ):
        assert df.collect() == []


def test_exact_dedup(odd):
    got = exact_dedup.exact_dedup(odd).collect()
    groups = {}
    for doc_id, text, _ in odd_rows():
        bare = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(hashlib.sha256(bare.encode()).hexdigest(), []).append((-len(text or ""), doc_id is None, doc_id))
    assert len(got) == len(odd_rows())
    for r in got:
        best = min(groups[r.text_sha256])
        assert (r.keep_id, r.group_size) == (best[2], len(groups[r.text_sha256]))
    for key in groups:
        kept = [r for r in got if r.text_sha256 == key and r.kept]
        assert len(kept) == 1 and kept[0].doc_id == kept[0].keep_id
    rest = exact_dedup.without_copies(odd)
    assert rest.columns == odd.columns and rest.count() == len(groups)


def test_mixing(spark, odd):
    rows = mixing.mix(odd, seed=7).collect()
    assert rows and sorted(map(str, mixing.mix(odd, seed=7).collect())) == sorted(map(str, rows))
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    volume = {}
    for _, text, source in odd_rows():
        volume[source] = volume.get(source, 0) + count(text)
    names = sorted(volume, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, clamped = {}, set()
    while True:
        left = sum(volume.values()) - sum(3 * volume[s] for s in clamped)
        share = left / sum(weight[s] for s in names if s not in clamped)
        target = {s: 3 * volume[s] if s in clamped else weight[s] * share for s in names}
        above = {s for s in names if s not in clamped and target[s] > 3 * volume[s] * (1 + 1e-12)}
        if not above:
            break
        clamped |= above
    assert sum(r.taken for r in rows) == pytest.approx(sum(volume.values()), abs=len(names))
    assert {round(r.target, 6) for r in rows} == {round(t, 6) for t in target.values()}
    assert all(r.taken <= 3 * r.size and r.source_size in volume.values() for r in rows)
    mixed = mixing.mixed(odd, seed=7)
    assert mixed.columns == odd.columns
    assert sum(count(r.text) for r in mixed.collect()) == sum(r.taken for r in rows)


def fingerprint(text):
    seen = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not seen:
        return 0
    parts = [" ".join(seen[i : i + 3]) for i in range(len(seen) - 2)] if len(seen) > 2 else [" ".join(seen)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def similarities(texts):
    """Jaccard similarity of the sets of five-word shingles, for pairs that share one."""
    sets, holders, shared = {}, {}, {}
    for i, text in texts.items():
        seen = (text or "").lower().split()
        sets[i] = {tuple(seen[k : k + 5]) for k in range(max(1, len(seen) - 4))}
        for s in sets[i]:
            for j in holders.setdefault(s, []):
                shared[j, i] = shared.get((j, i), 0) + 1
            holders[s].append(i)
    return {(i, j): n / (len(sets[i]) + len(sets[j]) - n) for (i, j), n in shared.items()}


def test_simhash_of_similar_texts(spark):
    rows, draw = odd_rows(), random.Random(5)
    for i in range(80):
        base = words(i // 4, 200 + i)
        for _ in range(i % 4):  # each changed word takes five shingles away
            base[draw.randrange(200)] = "changed"
        rows.append((100 + i, " ".join(base[: 200 + i // 4]), "n"))
    docs = frame(spark, rows)
    kept = simhash.one_of_similar(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None and r.doc_id >= 100)
    assert ids == [100 + 4 * i for i in range(20)]
    apart = frame(spark, [(i, " ".join(words(1000 + i, 60)), "n") for i in range(50)])
    assert simhash.one_of_similar(apart).count() == 50
    assert simhash.one_of_similar(docs.limit(0)).count() == 0


def edited(draw, base, kind, share):
    """A copy of `base` with about `share` of its shingles common to both."""
    n, fresh = len(base), [f"v{draw.randrange(10**6)}" for _ in range(len(base))]
    if kind == "appended":
        return base + fresh[: int(n * (1 / share - 1))]
    if kind == "cut off":
        return base[: int(n * share)]
    gone = int(n * (1 - share) / (1 + share))
    if kind == "replaced":
        at = draw.randrange(n - gone)
        return [*base[:at], *fresh[:gone], *base[at + gone :]]
    copy = list(base)
    for at in draw.sample(range(n), max(1, gone // 5)):
        copy[at] = fresh[at]
    return copy


@pytest.mark.parametrize("kind", ["appended", "cut off", "replaced", "scattered"])
def test_simhash_of_every_kind_of_edit(spark, kind):
    draw, rows = random.Random(kind), []
    for i in range(60):
        base = [f"u{draw.randrange(10**5)}" for _ in range(draw.choice([120, 400, 1500]))]
        rows += [(2 * i, " ".join(base), "n"), (2 * i + 1, " ".join(edited(draw, base, kind, draw.choice([0.83, 0.87, 0.92]))), "n")]
    alike = similarities({i: t for i, t, _ in rows})
    stayed = {r.doc_id for r in simhash.one_of_similar(frame(spark, rows)).collect()}
    assert sum(share >= 0.8 for share in alike.values()) > 40
    assert not [pair for pair, share in alike.items() if share >= 0.8 and set(pair) <= stayed]
    assert {i for i, _, _ in rows} - stayed <= {i for pair, share in alike.items() if share >= 0.8 for i in pair}


def test_simhash_of_crowds(spark, monkeypatch):
    """Unrelated texts of the same few words, and texts that have a template in common, each with a near copy of its own."""
    monkeypatch.setattr(simhash, "FEW", 3)
    draw, rows = random.Random(8), []
    template = [f"t{draw.randrange(10**5)}" for _ in range(300)]
    for i in range(80):
        base = [f"w{draw.randrange(40)}" for _ in range(500)] if i % 2 else template + [f"u{draw.randrange(10**5)}" for _ in range(110)]
        copy = base[:-12] + [f"w{draw.randrange(40)}" for _ in range(20)]
        rows += [(2 * i, " ".join(base), "n"), (2 * i + 1, " ".join(copy), "n")]
    alike = similarities({i: t for i, t, _ in rows})
    assert all(alike[2 * i, 2 * i + 1] >= 0.8 for i in range(80)) and sum(0.5 < share < 0.8 for share in alike.values()) > 1000
    assert sum(share >= 0.8 for share in alike.values()) == 80
    assert sorted(r.doc_id for r in simhash.one_of_similar(frame(spark, rows)).collect()) == list(range(0, 160, 2))


def test_sketches_lose_no_similar_pair():
    """Over the bands that a pair shares, it is named once if it is similar, whatever bands are open, and never within a component."""
    draw = np.random.default_rng(4)
    base = draw.integers(-(2**31), 2**31, 300).astype(np.int32)
    sets = [np.unique(np.r_[base[draw.random(300) > gone], draw.integers(-(2**31), 2**31, int(300 * gone))]).astype(np.int32) for gone in draw.uniform(0, 0.3, 90)]
    least = [simhash.minima(x) for x in sets]
    keys = np.array([simhash.minhash_keys(x) for x in least])
    opened = draw.random(simhash.BANDS) > 0.2  # a key is open or not for all who have it
    rows = pd.DataFrame({"node": np.arange(90), "root": np.arange(90) // 3, "n": [len(x) for x in sets], "sketch": [simhash.sketch(x) for x in least]})
    rows["open"] = sum(1 << b for b in range(simhash.BANDS) if opened[b])
    found = []
    for band in np.flatnonzero(opened):
        for key in np.unique(keys[:, band]):
            group = rows[keys[:, band] == key]
            left, right = simhash._maybe_similar(group[group["root"] % 2 == 1], group, int(band), None)
            found += zip(left.tolist(), right.tolist())
    assert len(found) == len(set(found)) and not [p for p in found if p[0] // 3 == p[1] // 3]
    wanted = set()
    for i, j in itertools.product(range(90), range(90)):
        both = len(np.intersect1d(sets[i], sets[j]))
        if i // 3 != j // 3 and i // 3 % 2 == 1 and (keys[i] == keys[j])[opened].any() and both * 5 >= (len(sets[i]) + len(sets[j]) - both) * 4:
            wanted.add((i, j))
    assert len(wanted) > 100 and wanted <= set(found)


def test_simhash_of_one_large_group(spark, monkeypatch):
    """Copies of one text whose word sets hardly differ, in more than one upper node."""
    monkeypatch.setattr(simhash, "GROUP_ROWS", 64)
    draw, base, rows = random.Random(6), words(77, 300), []
    for i in range(600):
        copy = list(base)
        copy[draw.randrange(300)] = f"w{draw.randrange(40)}"
        rows.append((i, " ".join(copy), "n"))
    assert [r.doc_id for r in simhash.one_of_similar(frame(spark, rows)).collect()] == [0]


def test_simhash(spark):
    rows, draw = odd_rows(), random.Random(3)
    for i in range(60):
        base = words(i // 6, 150)
        for _ in range(draw.choice([0, 0, 1, 2, 6])):
            base[draw.randrange(150)] = "changed"
        rows.append((100 + i, " ".join(base), "n"))
    docs = frame(spark, rows)
    got = simhash.near_duplicates(docs).collect()
    fps = [fingerprint(t) for _, t, _ in rows]
    assert sorted((str(r.doc_id), r.fingerprint) for r in got) == sorted((str(d), f"{f:016x}") for (d, _, _), f in zip(rows, fps))
    root = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(fps):
            root[i] = min(root[j] for j, b in enumerate(fps) if (a ^ b).bit_count() <= 3)
    least = {r: min([d for (d, _, _), x in zip(rows, root) if x == r and d is not None], default=None) for r in set(root)}
    want = sorted(str((d, least[x])) for (d, _, _), x in zip(rows, root))
    assert sorted(str((r.doc_id, r.component_id)) for r in got) == want
    assert len(set(root)) < len(set(fps)), "the fixture has links between different fingerprints"
    assert simhash.one_of_each(docs).count() == len(set(root))


def test_simhash_factors_crowded_patterns(spark, monkeypatch):
    draw = np.random.default_rng(1)
    centre = draw.integers(0, 2**63, 12)
    flips = np.array([[1 << int(b) for b in draw.permutation(63)[:2]] for _ in range(400)]).sum(axis=1)
    codes = np.unique(np.r_[np.repeat(centre, 400 // 12 + 1)[:400] ^ flips, draw.integers(0, 2**63, 300)])
    monkeypatch.setattr(simhash, "GROUP_ROWS", 8)
    edges = simhash.links(spark.createDataFrame([(int(c),) for c in codes], "fp long"), 3).collect()
    parent = {int(c): int(c) for c in codes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for e in edges:
        assert find(e.src) is not None
        parent[find(e.src)] = find(e.dst)
    for i, c in enumerate(codes):
        for d in codes[i + 1 :][np.bitwise_count(codes[i + 1 :] ^ c) <= 3]:
            assert find(int(c)) == find(int(d))
    classes = {}
    for c in parent:
        classes.setdefault(find(c), []).append(c)
    for members in classes.values():  # nothing is linked that is not reachable
        seen, todo = {members[0]}, [members[0]]
        while todo:
            x = todo.pop()
            near = [m for m in members if m not in seen and (m ^ x).bit_count() <= 3]
            seen.update(near)
            todo += near
        assert len(seen) == len(members)


def test_packing(odd):
    got = packing.packed(odd, BYTE_BPE).toPandas()
    library = tokens.Encoder(BYTE_BPE)
    want = sorted((len(library._library([t])[0]) // 4 if t else 0) + 1 for _, t, _ in odd_rows())
    parts = got[got.doc_id == 9].sort_values("start")
    ids = library._library([odd_rows()[11][1]])[0] + b"\x01\0\0\0"
    for p in parts.itertuples():
        assert p.ids_crc32 == zlib.crc32(ids[4 * p.start : 4 * (p.start + p.length)])
    assert parts.length.sum() == len(ids) // 4 and got.length.sum() == sum(want)
    for _, window in got.sort_values("offset").groupby("sequence_id"):
        assert list(window.offset) == [0, *np.cumsum(window.length)[:-1]]
        assert window.length.sum() + window.padding.iloc[0] == window.tier.iloc[0] <= 2048


def test_pack_places_every_token_once():
    draw = random.Random(5)
    for _ in range(40):
        lengths = [draw.choice([1, 3, 100, 128, 512, 700, 1500, 2047, 2048, 2049, 5000]) for _ in range(draw.randrange(1, 60))]
        covered = {d: [] for d in range(len(lengths))}
        for tier, pieces in (made := packing.pack(lengths, 2048)):
            assert sum(p[2] for p in pieces) == tier
            for d, at, n in pieces:
                covered[d].append((at, n))
        for d, n in enumerate(lengths):
            at = 0
            for start, size in sorted(covered[d]):
                assert start == at
                at += size
            assert at == n
        steps = packing.step_groups(made, 4096)
        for s in set(steps):
            tiers = [t for (t, _), x in zip(made, steps) if x == s]
            assert len(set(tiers)) == 1 and sum(tiers) <= max(4096, tiers[0])


@pytest.mark.parametrize("name", [BYTE_BPE, WORD_BPE])
def test_pieces_encode_as_the_whole_text(spark, folder, name):
    texts = [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("text").collect()]
    texts += [" a  b\n\nc \n d's don't ,,x. y.,z\n", "<|endoftext|>x", "a <|endoftext|>", "", "\n", "a\tb  c", "é é", "word,word .'s ½ x² 12,5", "A\n\n", "\n\nA", "a b  c"]
    coder = tokens.Encoder(name)
    assert coder.cut
    assert [coder.ids(t) for t in texts] == coder._library(texts)


@pytest.mark.parametrize("name", [BYTE_BPE, WORD_BPE])
def test_every_letter_before_every_stop(name):
    letters = [c for c in map(chr, range(0x41, 0x250)) if c.isalpha()]
    texts = [f"{a}{c}{s}{end}" for c in letters for s in ".,!?;:" for a in ("", "x", " B") for end in ("", " y", "\n", "z")]
    texts += ["İ?", "BELEDİYESİ. İÇİN", "İ", "i̇.", "Iİ,İ"]
    coder = tokens.Encoder(name)
    assert [coder.ids(t) for t in texts] == coder._library(texts)


@pytest.mark.parametrize("name", [BYTE_BPE, WORD_BPE])
def test_words_go_to_the_model(name, monkeypatch):
    coder, library = tokens.Encoder(name), tokens.Encoder(name)
    letters = [c for c in map(chr, range(0x250)) if re.fullmatch(f"[{tokens._LETTER}]", c)]
    text = " ".join([a + b for a in letters for b in ("", "s", "\u00c9", "Of")] + ["".join(letters[i : i + 7]) for i in range(len(letters))])
    asked = []
    monkeypatch.setattr(coder, "_together", lambda pieces: asked.extend(pieces) or library._library(pieces))
    assert coder.ids(text) == library._library([text])[0]
    assert not asked  # the steps before the model take several times as long
    assert coder.ids(text + ", 7") == library._library([text + ", 7"])[0]
    assert asked


def test_an_encoder_remembers_few_pieces(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 1000)
    coder, library = tokens.Encoder(BYTE_BPE), tokens.Encoder(BYTE_BPE)
    coder.ids(" frequent")
    for i in range(30):
        text = " ".join("x" + "".join(chr(97 + int(d)) for d in str(1000 * i + j)) for j in range(100))
        assert coder.ids(text) == library._library([text])[0]
        assert len(coder.known) <= 1000
    assert " frequent" in coder.known  # all were forgotten at once before


def test_token_store(spark, odd, tmp_path):
    folder = f"file://{tmp_path}/store"
    files = token_store.write_store(odd, folder, WORD_BPE)
    got = token_store.read_store(files, folder).collect()
    coder, at = tokens.Encoder(WORD_BPE), 0
    known = sorted((d, t) for d, t, _ in ((r[0], r[1] or "", r[2]) for r in odd_rows()) if d is not None)
    by_id = {}
    for doc_id, text in known:
        ids = (coder._library([text])[0] if text else b"") + b"\x01\0\0\0"
        by_id.setdefault(doc_id, []).append((at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    assert len(got) == len(odd_rows()) and max(r.start for r in got if r.doc_id is None) >= at
    for doc_id, rows in by_id.items():
        assert sorted((r.start, r.n_tokens, r.ids_crc32) for r in got if r.doc_id == doc_id) == rows
    some = token_store.read_store(files, folder, wanted=[7, 10]).collect()
    assert sorted(r.doc_id for r in some) == [7, 10]


def test_store_reads_only_what_it_needs_and_checks_it(tmp_path):
    path, draw = tmp_path / "x.zst", np.random.default_rng(2)
    docs = [draw.integers(0, 40_000, n).astype("<u4") for n in (5, 0, 300_000, 1, 200_000, 7)]
    with open(path, "wb") as f:
        writer = token_store.FileWriter(f, wide=False)
        for i, ids in enumerate(docs):
            writer.add(i, ids)
        writer.close()
    with open(path, "rb") as f:
        reader = token_store.FileReader(f, path.stat().st_size)
        assert all((reader.document(i) == ids).all() for i, ids in enumerate(docs))
        reader = token_store.FileReader(f, path.stat().st_size)
        assert reader.document(5).tolist() == docs[5].tolist() and reader.frames_read == 1 < len(reader.sums)
    data = bytearray(path.read_bytes())
    data[100] ^= 255
    broken = tmp_path / "y.zst"
    broken.write_bytes(data)
    with open(broken, "rb") as f, pytest.raises(Exception):
        token_store.FileReader(f, len(data)).document(0)
    with open(path, "rb") as f, pytest.raises(token_store.StoreError):
        token_store.FileReader(f, 40)


def test_quality(spark, odd, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.learn(docs, labels)
    got = quality.scored(docs, model).toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all() and ((got.score >= 0.5) == (got.predicted == 1)).all()
    assert all(h == (zlib.crc32(str(d).encode()) % 3 == 1) for d, h in zip(got.doc_id, got.held_out))
    seen = got.merge(labels.toPandas(), on="doc_id")
    held = seen[seen.held_out]
    assert (held.predicted == held.quality).mean() >= 0.95
    strange = quality.scored(odd, model).toPandas()
    assert len(strange) == len(odd_rows()) and strange.score.between(0, 1).all() and not strange[strange.doc_id.isna()].held_out.any()
    assert quality.good_ones(odd, model).columns == odd.columns
    one_kind = quality.learn(docs, labels.where("quality = 1"))
    assert set(quality.scored(odd, one_kind).toPandas().score) == {0.5}


def test_token_counts(spark, odd, tmp_path):
    cache = f"{tmp_path}/cache"
    coder = tokens.Encoder(BYTE_BPE)
    want = sorted((str(d), len((t or "").encode()), len(coder._library([t])[0]) // 4 if t else 0) for d, t, _ in odd_rows())
    for _ in range(2):
        got = token_counts.token_counts(odd, BYTE_BPE, limit=100, cache=cache).collect()
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 100) for r in got)
        stored = spark.read.parquet(cache)
        assert stored.count() == len({t or "" for _, t, _ in odd_rows()}), "each distinct text is encoded once, over both runs"


def test_neighbours(spark):
    draw = np.random.default_rng(4)
    centres = draw.standard_normal((6, 16))
    vectors = [(i, (centres[i % 6] + 0.4 * draw.standard_normal(16)).tolist()) for i in range(1500)]
    vectors += [(2000 + i, vectors[3][1]) for i in range(40)]  # ties; 2000 asks too
    odd = [(None, [1.0] * 16), (5000, None), (5001, [0.0] * 16), (5002, [float("nan")] * 16), (5003, [None] * 16), (5100, [float("inf")] * 16), (5200, [1.0]), (5300, []), (7, vectors[7][1])]
    got = neighbours.nearest(spark.createDataFrame(vectors + odd, "vec_id long, embedding array<double>")).toPandas()
    ids, x = np.array([v[0] for v in vectors]), np.array([v[1] for v in vectors])
    hits = 0
    asked = ids[ids % 100 == 0]
    for q in asked:
        away = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        away[ids == q] = np.inf
        best = np.lexsort((ids, away))[:10]
        mine = got[got.query_id == q].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 11))
        assert np.allclose(mine.score, [away[ids == v][0] for v in mine.vec_id], rtol=0, atol=1e-12)
        hits += len(set(mine.vec_id) & set(ids[best]))
        if q == 2000:
            assert list(mine.vec_id) == [3, *range(2001, 2010)]
    assert set(got.query_id) == set(asked) and hits >= 0.9 * 10 * len(asked)
    few = neighbours.nearest(spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0])], "vec_id long, embedding array<float>")).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in few] == [(0, 1, 1)]
    assert neighbours.chi_square_quantile(0.95, 10) == pytest.approx(18.307, abs=1e-3)


def test_substring_dedup(spark, odd):
    passage = " ".join(words(77, 70))
    rows = [(i, " ".join(words(200 + i, 150)), "s") for i in range(12)]
    for i in (2, 5, 9):
        w = rows[i][1].split()
        rows[i] = (i, " ".join([*w[: 20 * i], passage, *w[20 * i :]]), "s")
    rows += [(20, None, "s"), (21, "", "s"), (None, passage, "s"), (22, "the " * 500 + passage[:100], "s")]
    rows[3] = (3, rows[3][1] + " " + " ".join(passage.split()[:12]), "s")  # too short to count
    docs = frame(spark, rows)
    spans = substring_dedup.repeated_spans(docs)
    got = spans.collect()
    assert {r.doc_id for r in got} == {2, 5, 9}
    assert {(r.doc_id, r.dropped, r.first_doc_id) for r in got} == {(2, False, 2), (5, True, 2), (9, True, 2)}
    text = {i: t for i, t, _ in rows}
    for r in got:
        assert passage.encode().find(text[r.doc_id].encode()[r.start : r.start + r.length].strip()) >= 0
    left = {r.doc_id: r.text for r in substring_dedup.without_repeats(docs, spans).collect()}
    assert left[2] == text[2] and passage not in left[5] and left[5].startswith(text[5][:50]) and left[20] is None
    assert {r.doc_id for r in substring_dedup.repeated_spans(odd).collect()} == {7, 8, 9}
    ends = substring_dedup.cuts(b"ab" * 9000)
    assert ends[-1] == 18_000 and np.diff(np.r_[0, ends]).max() <= substring_dedup.LONGEST


def test_substring_dedup_cuts_many_texts_at_a_time(spark, monkeypatch):
    draw = random.Random(4)
    words = lambda n: " ".join("".join(draw.choices("abcdefgh", k=6)) for _ in range(n))
    first, second = words(50), words(60)
    texts = [f"{words(9)}{own}x {first} y{own}{words(12)}{own}z {second} {own}{words(5)}" for own in "ijklmnopqrst"]
    plans = []
    monkeypatch.setattr(substring_dedup, "TEXTS_AT_ONCE", 5)
    monkeypatch.setattr(substring_dedup, "written", lambda df, purpose: plans.append((purpose, df._jdf.queryExecution().toString())) or session.written(df, purpose))
    got = substring_dedup.repeated_spans(frame(spark, [(i, text, "a") for i, text in enumerate(texts)]).coalesce(1)).collect()
    found = {(r.doc_id, texts[r.doc_id].encode()[r.start : r.start + r.length].decode().strip(" xyz")) for r in got}
    assert found == {(i, passage) for i in range(12) for passage in (first, second)}
    assert "MapInArrow" in dict(plans)["near"]  # a data frame for each text took most of the time before


def test_substring_dedup_of_several_texts_with_one_id(spark):
    passage = " ".join(words(78, 90))
    texts = [f"{' '.join(words(300 + i, n))} {passage} {' '.join(words(400 + i, 40))}" for i, n in enumerate([30, 33, 90])]
    docs = frame(spark, [(1, texts[0], "s"), (5, texts[1], "s"), (5, texts[2], "s"), (5, texts[2], "s")])
    spans = substring_dedup.repeated_spans(docs)
    got = spans.collect()
    assert sorted((r.doc_id, r.dropped) for r in got) == [(1, False), (5, True), (5, True)]
    assert len({r.row_key for r in got}) == 3 and all(r.words >= 60 for r in got)
    left = [r.text for r in substring_dedup.without_repeats(docs, spans).collect()]
    assert len(left) == 4 and texts[0] in left and sum(passage in t for t in left) == 1
    for i, text in enumerate(texts):
        assert any(t.startswith(" ".join(words(300 + i, 20))) and t.endswith(" ".join(words(400 + i, 40)[25:])) for t in left)


def test_substring_dedup_of_short_words_and_text_without_spaces(spark):
    draw, rows, want = random.Random(4), [], {}
    short = lambda n: " ".join("".join(draw.choice("abcdefghijklmnop") for _ in range(draw.choice([2, 2, 3]))) for _ in range(n))
    signs = lambda n: "".join(chr(draw.randrange(0x4E00, 0x9000)) for _ in range(n))
    for i in range(100):
        passage, fill = (short(51), short) if i % 4 else (signs(90), signs)
        space = " " if i % 4 else ""
        before, behind = [fill(draw.randrange(60, 90)) + space for _ in range(2)], [space + fill(50) for _ in range(2)]
        left, right = (len(os.path.commonprefix(x)) for x in ([t[::-1] for t in before], behind))  # by chance
        for k in (0, 1):
            rows.append((2 * i + k, before[k] + passage + behind[k], "s"))
            start = len(before[k]) - left
            want[2 * i + k] = [(len(before[k][:start].encode()), len(rows[-1][1][start : len(before[k] + passage) + right].encode()))]
    got = {}
    for r in substring_dedup.repeated_spans(frame(spark, rows)).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.length))
        assert r.doc_id // 2 % 4 == 0 or 51 <= r.words <= 54
    assert {i: (got.get(i), want[i]) for i in want if got.get(i) != want[i]} == {}


def test_licences(spark):
    notice = "Licensed under the Apache License, Version 2.0."
    rows = [
        (1, "h/a/LICENSE", "Released under the MIT License."), (2, "h/a/b/c/x.py", "code only"), (3, "h/a/b/y.py", f"words\n{notice}\nmore"),
        (4, "h/other/z.py", "code"), (5, "h/a/b/LICENSE.txt", notice), (6, None, None), (7, "h/a/b/d/w.py", ""), (8, "lone.py", f"<p>{notice}</p>"),
        (9, "h/a", "plain"), (9, "h/a", "plain"),
    ]
    got = licenses.scan(spark.createDataFrame([(*r, "x") for r in rows], "file_id long, path string, text string, own string")).collect()
    found = {r.file_id: (r.licence, r.how, r.licensed_by) for r in got}
    assert len(got) == len(rows)
    assert found[1] == ("MIT", "own", None) and found[2] == ("Apache-2.0", "inherited", "h/a/b") and found[3][:2] == ("Apache-2.0", "own")
    assert found[4] == (None, "none", None) and found[6] == (None, "none", None) and found[7] == ("Apache-2.0", "inherited", "h/a/b")
    assert found[8][:2] == ("Apache-2.0", "own") and found[9] == (None, "none", None)


def test_licences_in_windows(spark):
    import pathlib
    import textwrap

    whole = {n: (pathlib.Path(licenses.__file__).parent / "licence_texts" / f"{n}.txt").read_text() for n in licenses.TEXTS}
    gpl = licenses.HEADERS[1][1]
    prose = " ".join(words(5, 60))
    wrapped = lambda t: "\n".join(f" * {x}" for x in textwrap.wrap(t, 60))
    rows = [(f"h/{n}/LICENSE", t, n) for n, t in whole.items()]
    rows += [(f"h/one/{n}.txt", "Copyright (c) 2020 Somebody " + " ".join(t.split()), n) for n, t in whole.items()]
    rows += [
        ("a.c", wrapped(gpl) + "\nint main() {}", "GPL-3.0"), ("b.c", wrapped(gpl.replace("version 3", "version 2")) + "\nint x;", "GPL-2.0"),
        ("c.c", wrapped(gpl.replace("General", "Lesser General").replace("program", "library").replace("version 3", "version 2.1")), "LGPL-2.1"),
        ("d.html", "<p>This work is licensed under the <a href='x'>GNU General Public License</a>, version 3.</p>", "GPL-3.0"),
        ("e.html", f"<p>{prose} Released under the MIT License. {prose}</p>", "MIT"), ("f.txt", f"{prose} released under the Foo License. {prose}", None),
        ("g.txt", f"{prose} permission licence {prose}", None), ("h/MIT/x/y.py", "code", "MIT"),
    ]
    files = spark.createDataFrame([(i, p, t) for i, (p, t, _) in enumerate(rows)], "file_id long, path string, text string")
    found = {r.path: r.licence for r in licenses.scan(files).collect()}
    assert found == {p: n for p, _, n in rows}


def test_registered_sql(spark, folder):
    from compare import duck, rows_of
    from reelhouse.llm.queries import QUERIES, SQL

    con = duck(folder)
    for name, sql in SQL.items():
        df, res = QUERIES[name](spark, folder), con.execute(sql)
        assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([d[0] for d in res.description], res.fetchall())


def test_pipeline_stages(spark, folder):
    import corpus_pipeline

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality_classifier"](spark, docs, folder)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert sum(q == (i in ids) for i, q in labels.items()) >= 0.95 * len(labels)
    from reelhouse.session import written

    kept = written(kept, "test")
    texts = [(r.doc_id, r.text) for r in kept.collect()]
    best = {}
    for doc_id, text in texts:
        best.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text), []).append((-len(text), doc_id))
    single = written(stages["exact_dedup"](spark, kept, folder), "test")
    assert {r.doc_id for r in single.collect()} == {min(x)[1] for x in best.values()} and single.count() == len(best)
    near = written(stages["simhash_dedup"](spark, single, folder), "test")
    classes = {r.component_id for r in simhash.near_duplicates(single).collect()}
    stayed = {r.doc_id for r in near.collect()}
    assert stayed <= classes and near.count() == len(stayed) and near.columns == docs.columns
    alike = similarities({r.doc_id: r.text for r in single.collect()})
    assert not [pair for pair, share in alike.items() if share >= 0.8 and set(pair) <= stayed]
    partners = {i for pair, share in alike.items() if share >= 0.65 for i in pair}
    assert classes - stayed <= partners, "only documents with a similar one go"
    mixed = written(stages["source_mix"](spark, near, folder), "test")
    plan = mixing.mix(near).toPandas()
    assert sum(len(r.text.split()) for r in mixed.collect()) == pytest.approx(plan.taken.sum(), rel=0.01) and mixed.columns == docs.columns
    pieces = stages["packing"](spark, mixed, folder).toPandas()
    ends = pieces[pieces.start + pieces.length == pieces.doc_tokens]
    assert len(ends) == mixed.count()
    assert isinstance(pieces, pd.DataFrame) and (pieces.groupby("sequence_id").length.sum() <= 2048).all()
