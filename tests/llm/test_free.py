"""Near-duplicates, pieces, shards, token files and classifiers against plain Python."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from deskquery.llm import labelled, piece_lattice, quality_classifier, sharding, simhash, token_files, toxicity
from tests.llm.test_native import ODD, docs

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def components(fps):
    """fingerprint: smallest fingerprint reachable."""
    fps = sorted(set(fps))
    root = {f: f for f in fps}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if bin((a ^ b) & (2**64 - 1)).count("1") <= 4:
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {f: top(f) for f in fps}


def test_fingerprint():
    def plain(text):
        words = (text or "").encode().lower().split()
        runs = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
        h = [xxhash.xxh64_intdigest(r, 42) for r in runs]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    for _, t in ODD:
        assert simhash.fingerprint(t) & (2**64 - 1) == plain(t)


@pytest.mark.parametrize("chunk", [2048, 3])
def test_links(spark, chunk):
    rng = random.Random(3)
    fps = []
    for _ in range(30):
        base = rng.getrandbits(64)
        for _ in range(rng.randint(1, 14)):
            x = base
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.randrange(64)
            fps.append(x)
    signed = [x - 2**64 if x >= 2**63 else x for x in fps]
    edges = simhash.links(spark.createDataFrame([(x,) for x in set(signed)], "fp long"), chunk)
    got = {r.node: r.label for r in simhash.components(edges).collect()}
    want = components(signed)
    assert {f: got.get(f, f) for f in want} == want
    assert edges.count() <= 20 * len(fps)


def test_near_duplicates(spark):
    words = [f"w{i}" for i in range(300)]
    copy = " ".join(words)
    near = " ".join([*words[:299], "other"])
    rows = [*ODD, (50, copy), (51, copy), (52, near), (53, copy.upper()), (53, copy.upper()), (60, "something else here now and then")]
    got = {(r.doc_id, r.fp): r.component_id for r in simhash.near_duplicates(docs(spark, rows)).collect()}
    fps = {(i, simhash.fingerprint(t)) for i, t in rows}
    by = defaultdict(list)
    for i, f in fps:
        by[components([f for _, f in fps])[f]].append((i, f))
    for members in by.values():
        smallest = min((i for i, _ in members if i is not None), default=None)
        assert {got[m] for m in members} == {smallest}
    kept = simhash.first_of_each(docs(spark, rows))
    assert kept.count() == len(by) and kept.columns == ["doc_id", "text", "source", "n_words"]
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


def test_pieces(spark, monkeypatch):
    rows = [*ODD, (70, "hello, world! it's 12.5% of  3   spaces\t\nx = y_{1}; ▁ 日本 \U0001f600 é”, ñ.a ▁▁b"), (71, "nocuts" * 4000), (72, "long" * 40 + " and rare zxqj")]
    table, texts = piece_lattice.pieces(PIECES), dict(rows)
    for vocabulary, batch in ((1 << 18, 1 << 20), (4, 1), (0, 1)):  # frequent words broadcast, almost none, none; one batch, and one a slice
        monkeypatch.setattr(piece_lattice, "BATCH", batch)
        found = piece_lattice.encode(docs(spark, rows).repartition(3), PIECES, vocabulary).collect()
        assert sorted(str(r.doc_id) for r in found) == sorted(str(i) for i, _ in rows)
        for r in found:
            text = texts[r.doc_id] or ""
            assert r.decoded == text.replace("▁", " ")
            assert r.n_pieces == len(r.ids) and r.source == "src" and r.n_words == 7
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
            if 0 < len(text) < 500:
                words = table.split(text)
                assert "".join(words) == f" {text}".replace("▁", " ")
                assert r.ids == [i for w in words for i in table.segment(w)]
    assert piece_lattice.encode(docs(spark, []), PIECES).count() == 0


def test_pieces_names(spark):
    rows = spark.createDataFrame([(1, "a b", 2, "x", 5)], "doc_id long, text string, `a.b` int, _ string, n_pieces int")
    (r,) = piece_lattice.encode(rows, PIECES).collect()
    assert (r["a.b"], r["_"], r.n_pieces) == (2, "x", len(r.ids)) and r.decoded == "a b"


def test_lattice(spark):
    table = piece_lattice.pieces(PIECES)
    words = [" hello", " unseenwordxyz", ",", "日本語", " ñandú\U0001f600", " ", "   ", "\n", "q" * 300, " " + "abcdefgh" * 40]  # over 64 characters too
    found = {r.word: r.ids for r in piece_lattice.segmented(spark.createDataFrame([(w,) for w in words], "word string"), table).collect()}
    assert found == {w: table.segment(w) for w in words}


def test_lattice_carries_numbers(spark):
    """Edges are made before they are grouped, the fold never concatenates, other columns come once a word."""
    table = piece_lattice.pieces(PIECES)
    words = [(" hello", [1, 2]), ("日\U0001f600x", None), ("q" * 300, []), (" ", [3])]
    found = piece_lattice.segmented(spark.createDataFrame(words, "word string, ats array<int>"), table)
    assert {r.word: (r.ids, r.ats) for r in found.collect()} == {w: (table.segment(w), ats) for w, ats in words}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(edge#" in plan and "concat(" not in plan
    top = (1 << 20) - 1
    edge = piece_lattice._edge(F.lit(top), F.lit(top - 1), F.col("id"))
    for known, want in ((31_999, 31_999), (0, 0), (None, -top)):
        row = spark.createDataFrame([(known,)], "id int").select(edge.alias("e")).select(piece_lattice._end(F.col("e")), piece_lattice._start(F.col("e")), piece_lattice._id(F.col("e")))
        assert tuple(row.first()) == (top, top - 1, want)


def test_lattice_takes_all_words(spark, monkeypatch):
    rows = docs(spark, [(1, " ".join(f"rare{i}word" for i in range(300)) + " " + "x" * 500)])
    want = [(r.ids, r.decoded) for r in piece_lattice.encode(rows, PIECES, vocabulary=0, longest=1).collect()]  # all by the recursion
    monkeypatch.setattr(piece_lattice, "_by_recursion", lambda words, model: spark.createDataFrame([], "batch long, place int, ids array<int>"))
    assert [(r.ids, r.decoded) for r in piece_lattice.encode(rows, PIECES, vocabulary=0).collect()] == want
    assert [(r.ids, r.decoded) for r in piece_lattice.encode(rows, PIECES).collect()] == want


def test_segment_is_best():
    table = piece_lattice.pieces(PIECES)

    def best(word):
        if not word:
            return 0.0
        return max([table.score[word[:k]] + best(word[k:]) for k in range(1, len(word) + 1) if word[:k] in table.score] + ([table.fallback + best(word[1:])] if word[0] not in table.score else []))

    score = {i: table.score[p] for p, i in table.ids.items()}
    for word in ("hello", "blending", "tion", "   x", "çãé", "'s"):
        assert sum(score[i] for i in table.segment(word)) == pytest.approx(best(word))
        assert sum(score[i] for i in table.segment(f" {word}")) == pytest.approx(best(f" {word}"))


def test_best_fit():
    rng = random.Random(5)
    for capacity in (50, 100):
        sizes = defaultdict(int)
        for _ in range(300):
            sizes[rng.randint(1, 60)] += 1
        rooms, want = [], {}
        for s in sorted(sizes, reverse=True):
            for _ in range(sizes[s]):
                fits = [(room, b) for b, room in enumerate(rooms) if room >= s]
                b = min(fits)[1] if fits else len(rooms)
                if not fits:
                    rooms.append(max(capacity, s))
                rooms[b] -= s
                want.setdefault(s, []).append(b)
        plan = sharding.best_fit(list(sizes.items()), capacity=capacity)
        got = {s: [next(b for end, b in runs if r < end) for r in range(sizes[s])] for s, runs in plan.items()}
        assert got == want


def test_shards(spark):
    rows = [(i, f"text {i} " * (i % 50 + 1)) for i in range(600)] + [(1000 + i, "same text") for i in range(100)] + ODD
    out = sharding.pack(docs(spark, rows), bins=4).collect()
    assert len(out) == len(rows)
    shards, texts = defaultdict(list), defaultdict(set)
    for r in out:
        shards[r.shard].append(r)
        texts[r.text_hash].add(r.shard)
    assert all(len(s) == 1 for s in texts.values())
    assert all(sorted(r.slot for r in s) == list(range(len(s))) for s in shards.values())
    loads = [sum(r.size for r in s) for s in shards.values()]
    assert max(loads) - min(loads) < 0.01 * sum(loads)
    assert sharding.pack(docs(spark, []), bins=4).count() == 0
    hot = sharding.pack(docs(spark, [(i, "x" * 100) for i in range(50)] + [(100 + i, f"{i}") for i in range(90)]), bins=4).collect()
    assert len({r.shard for r in hot if r.size == 101}) == 1 and len({r.shard for r in hot}) == 4


def test_shards_of_hot_rows(spark):
    rows = [(None, "same")] * 400 + [(i, f"t{i}") for i in range(400)]
    out = sharding.pack(docs(spark, rows).repartition(3), bins=4).collect()
    by = defaultdict(list)
    for r in out:
        by[r.shard].append(r.slot)
    assert len(out) == 800 and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert len({r.shard for r in out if r.size == 5 and r.doc_id is None}) == 1


def test_exact_capacity(spark):
    out = sharding.pack(docs(spark, [(1, "a" * 1024), (2, "b" * 1024)]), capacity=2050).collect()
    assert {r.shard for r in out} == {0}
    rng = random.Random(8)
    sizes = [rng.randint(900, 40_000) for _ in range(150)]
    out = sharding.pack(docs(spark, [(i, chr(97 + i % 26) * (n - 1)) for i, n in enumerate(sizes)]), capacity=50_000).collect()
    groups = {(r.text_hash): r.size * sum(x.text_hash == r.text_hash for x in out) for r in out}
    rooms = []
    for s in sorted(groups.values(), reverse=True):
        fits = [(room, b) for b, room in enumerate(rooms) if room >= s]
        if fits:
            rooms[min(fits)[1]] -= s
        else:
            rooms.append(max(50_000, s) - s)
    assert len({r.shard for r in out}) == len(rooms)


def test_held_out_is_never_null(spark):
    rows = spark.createDataFrame([(None,), (1,)], "doc_id long").select((labelled.remainder(3) == 1).alias("h")).collect()
    assert all(r.h is not None for r in rows)


def test_bits():
    rng = np.random.default_rng(1)
    for bits in (1, 5, 8, 11, 16, 17, 31, 32):
        ids = rng.integers(0, 1 << bits, 1001, dtype=np.uint64).astype(np.uint32)
        raw = token_files.pack_bits(ids, bits)
        assert len(raw) == (1001 * bits + 7) // 8
        assert (token_files.unpack_bits(raw, 1001, bits) == ids).all()


def test_random_access(tmp_path):
    path, rng = str(tmp_path / "x.tok"), np.random.default_rng(2)
    parts = [rng.integers(0, 1 << 17, n, dtype=np.uint32) for n in (0, 5, token_files.BLOCK * 2 + 3, 1, token_files.BLOCK)]
    writer = token_files.Writer(path, 17)
    for i, p in enumerate(parts):
        writer.add(i if i else None, p)
    writer.close()
    reader = token_files.Reader(path)
    for i in (3, 0, 2, 4, 1):
        assert (reader.document(i) == parts[i]).all()
    assert list(reader.nulls) == [1, 0, 0, 0, 0]


def test_token_files(spark):
    rows = [*ODD, (80, "it's <|endoftext|>done a\x1cb c\u0301 d \u0301 ΑΣ İ İ_. éÉß, Àb!!"), (81, "x  y\u2003z\x85q")]
    tokenizer = Tokenizer.from_file(WORDS)
    got = sorted(token_files.read_back(token_files.write(docs(spark, rows), WORDS, files=3)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    at, want = 0, defaultdict(list)
    for i, t in rows:
        want[i].append(zlib.crc32(np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()))
    for r in got:
        assert r.start == at and r.ids_crc32 in want[r.doc_id]
        at += r.n_tokens
    assert token_files.read_back(token_files.write(docs(spark, []), WORDS)).count() == 0


def test_other_tokenizer(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")  # keeps white space and case, so words depend on their neighbours
    assert not token_files.Encoder(path).by_word and token_files.Encoder(WORDS).by_word
    tokenizer = Tokenizer.from_file(path)
    want = {i: zlib.crc32(np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()) for i, t in ODD if i != 8}
    got = {r.doc_id: r.ids_crc32 for r in token_files.read_back(token_files.write(docs(spark, [r for r in ODD if r[0] != 8]), path, files=3)).collect()}
    assert got == want


def test_generations(monkeypatch):
    monkeypatch.setattr(token_files, "_KEPT", 20)
    rng, tokenizer = random.Random(9), Tokenizer.from_file(WORDS)
    encoder = token_files.Encoder(WORDS)
    for _ in range(30):
        texts = [" ".join(rng.choices(["a1.", "Über!", "it's", "x_y", "don", "NO", "end.", "z9", "é", "wide"], k=8)) + f" w{rng.randrange(40)}" for _ in range(3)]
        assert [x.tolist() for x in encoder.encode([t.encode() for t in texts])] == [[*tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in texts]


def test_hot_ids(spark):
    rows = [(7, f"copy {i}") for i in range(300)] + [(None, "none") for _ in range(200)] + [(i, "x") for i in range(100)]
    manifest = token_files.write(docs(spark, rows), WORDS, files=12)
    files = manifest.collect()
    assert sum(f.n_docs for f in files) == 600 and max(f.n_docs for f in files) <= 120 and len(files) >= 8
    got = sorted(token_files.read_back(manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None] * 200 + sorted(i for i, _ in rows if i is not None)
    assert got[0].start == 0 and all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:], strict=False))


def test_quality(spark):
    sf = "/root/testdata/sf0.1"
    d, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    found = quality_classifier.scored(d, labelled.sample(labels, "quality", 3, 1))
    held = found.join(labels, "doc_id").filter(labelled.remainder(3) == 1).select("score", "quality").collect()
    assert np.mean([(r.score >= 0.5) == bool(r.quality) for r in held]) > 0.97
    odd = quality_classifier.scored(docs(spark), labelled.sample(labels, "quality", 3, 1)).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)
    none = labels.limit(0).select("doc_id", F.col("quality").alias("label"))
    assert {r.score for r in quality_classifier.scored(docs(spark), none).collect()} == {0.5}
    assert quality_classifier.scored(docs(spark, []), none).count() == 0


def test_quality_fit(spark):
    rng = np.random.default_rng(4)
    f = rng.normal(size=(200, len(quality_classifier.NAMES)))
    y = rng.integers(0, 2, 200)
    f[y == 1] *= 2
    model = quality_classifier.fit(spark.createDataFrame([(x.tolist(), int(k)) for x, k in zip(f, y, strict=True)], "f array<double>, label int"), 0.2)
    pooled = sum((y == k).mean() * np.cov(f[y == k].T, bias=True) for k in (0, 1))
    logs = []
    for k in (0, 1):
        cov = 0.8 * np.cov(f[y == k].T, bias=True) + 0.2 * (np.diag(np.diag(pooled)) + quality_classifier.FLOOR * np.eye(len(pooled)))
        z = f - f[y == k].mean(0)
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", z, np.linalg.inv(cov), z) - 0.5 * np.linalg.slogdet(cov)[1])
    want = 1 / (1 + np.exp(-(model.prior + logs[1] - logs[0])))
    assert model.scores(f) == pytest.approx(want, abs=1e-6)


def test_segments():
    model = toxicity.Model({"bad ": 3.0, "awful ": 2.0}, 1.0)
    rng = random.Random(6)

    def plain(scores):
        """Maximal segments by definition: the best of the whole, then of what lies left and right of it."""
        if not scores or max(scores) <= 0:
            return []
        s, e = max(((a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), key=lambda x: (round(sum(scores[x[0] : x[1]]), 9), x[0] - x[1]))
        return plain(scores[:s]) + [(round(sum(scores[s:e]), 6),)] + plain(scores[e:])

    for _ in range(60):
        words = rng.choices(["bad", "awful", "fine", "ok"], [1, 1, 6, 6], k=rng.randint(0, 40))
        scores = [{"bad": 3.0, "awful": 2.0}.get(w, toxicity.LOSS) for w in words]
        assert [(round(x, 6),) for x, _, _ in model.segments(words)] == plain(scores)


def test_toxicity(spark):
    sf = "/root/testdata/sf0.1"
    d, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.fit(d, labelled.sample(labels, "toxic", 4, 2))
    held = toxicity.scored(d, model).join(labels, "doc_id").filter(labelled.remainder(4) == 2).select("score", "toxic").collect()
    assert np.mean([r.score >= 0.3 for r in held if r.toxic]) > 0.9
    assert np.mean([r.score < 0.3 for r in held if not r.toxic]) > 0.9
    odd = toxicity.scored(docs(spark), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)
    none = toxicity.fit(docs(spark), labels.limit(0).select("doc_id", F.col("toxic").alias("label")))
    assert none.scores == {} and none.score("idiot") == 0.0
    assert toxicity.scored(docs(spark, []), model).count() == 0


def test_bounded_sample(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(4000)] + [(1, 1), (None, 1), (5000, None)], "doc_id long, quality int")
    found = labelled.sample(labels, "quality", 3, 1, most=500).collect()
    assert 300 < len(found) < 700 and len({r.doc_id for r in found}) == len(found)
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 != 1 for r in found)
