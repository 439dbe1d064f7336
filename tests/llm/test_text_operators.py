"""Operators on texts against brute force, and their edge cases."""

import base64
import collections
import hashlib
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tracewright.llm import near_text, packing, pieces, quality, simhash, suffix_dedup, suffix_sort, token_counts, toxicity, warc
from tracewright.llm.common import fold_of
from tracewright.llm.components import connected_components, spanning

KIND = "doc_id long, text string"


def docs(spark, rows, kind=KIND):
    return spark.createDataFrame(rows, kind)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def words(rng, n, vocabulary=400):
    return " ".join(f"w{i}" for i in rng.integers(0, vocabulary, n))


# --- components ---------------------------------------------------------------

@pytest.mark.parametrize("finish", [0, 10_000])
def test_components(spark, finish):
    rng = np.random.default_rng(3)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + rng.integers(200, 260, (40, 2)).tolist() + [(7, 7)]
    df = spark.createDataFrame([tuple(map(int, e)) for e in edges] + [(None, 3)], "u long, v long")
    got = {r["u"]: r["root"] for r in connected_components(df, finish).collect()}
    e = np.array([x for x in edges if x[0] != x[1]])
    ids, root = spanning(e[:, 0], e[:, 1])
    assert got == dict(zip(ids.tolist(), root.tolist()))


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


# --- suffix sort and dedup ----------------------------------------------------

def test_suffix_sort_order():
    rng = np.random.default_rng(0)
    raw = rng.integers(97, 99, 400).astype(np.uint8)
    x = np.arange(300)
    cap = np.minimum(400 - x, rng.integers(1, 90, 300))
    group = rng.integers(0, 3, 300).astype(np.uint64)
    order, cls = suffix_sort.Suffixes(raw).sort(group, x, cap)
    text = [(int(group[i]), raw[x[i] : x[i] + cap[i]].tobytes()) for i in order]
    assert text == sorted(text)
    assert all((text[i] == text[i + 1]) == (cls[i] == cls[i + 1]) for i in range(299))


def test_collisions_are_verified(monkeypatch):
    rng = np.random.default_rng(1)
    raw = rng.integers(97, 99, 120).astype(np.uint8)
    s = suffix_sort.Suffixes(raw)
    s.sums[:] = 0  # every hash collides
    x = np.arange(60)
    order, cls = s.sort(np.zeros(60, np.uint64), x, np.full(60, 30))
    same = collections.defaultdict(set)
    for i, c in zip(order, cls, strict=True):
        same[c].add(raw[i : i + 30].tobytes())
    assert all(len(v) == 1 for v in same.values())


def brute_repeats(rows, span=50):
    data = [(i, (t or "").encode()) for i, t in rows]
    owner = {}
    for i, d in data:
        for p in range(len(d) - span + 1):
            k = d[p : p + span]
            owner[k] = min(owner.get(k, 1 << 62), (1 << 62) - 1 if i is None else i)
    out = []
    for i, d in data:
        gone = np.zeros(len(d), bool)
        for p in range(len(d) - span + 1):
            if owner[d[p : p + span]] < ((1 << 62) - 1 if i is None else i):
                gone[p : p + span] = True
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((i, len(d), runs, np.frombuffer(d, np.uint8)[~gone].tobytes()))
    return sorted(out, key=repr)


def repeat_rows():
    rng = np.random.default_rng(5)
    passage = [words(rng, 40, 30) for _ in range(4)]
    rows = []
    for i in rng.permutation(40).tolist():
        t = words(rng, int(rng.integers(0, 60)), 60)
        if rng.random() < 0.6:
            t += passage[rng.integers(4)][int(rng.integers(0, 30)) :] + " é" * int(rng.integers(0, 30)) + words(rng, 10, 60)
        rows.append((i, t))
    rows += [(50, None), (51, ""), (52, "short"), (53, "short"), (54, "ab" * 400), (55, "ab" * 300), (60, rows[0][1]), (60, rows[1][1]), (None, rows[2][1]), (61, passage[0]), (62, passage[0])]
    return rows + [(62, passage[0])]


@pytest.mark.parametrize("stretch", [128 << 10, 200])
def test_repeats_against_brute_force(spark, monkeypatch, stretch):
    monkeypatch.setattr(suffix_dedup, "STRETCH", stretch)
    rows = repeat_rows()
    df = docs(spark, rows).withColumns({"n_bytes": F.lit("clash"), "kept": F.lit(1)})
    got = suffix_dedup.remove_repeats(df, carry=["n_bytes", "kept"]).collect()
    assert sorted(((r["doc_id"], r["n_bytes"], len(r["starts"]), bytes(r["kept"])) for r in got), key=repr) == brute_repeats(rows)
    assert all(r["more_0"] == "clash" and r["more_1"] == 1 for r in got)


def test_repeats_of_nothing_and_as_text(spark):
    assert suffix_dedup.remove_repeats(docs(spark, [])).count() == 0
    rows = [(1, "é" * 60), (2, "x" + "é" * 59)]
    assert by_id(suffix_dedup.remove_repeats(docs(spark, rows), as_text=True))[2]["kept"] == "x"


def test_repeats_send_one_row_per_bucket_and_batch():
    """Rows sent follow the buckets, not the blocks in which a batch or a bucket is read."""
    import pyarrow as pa
    import pyarrow.compute

    rng = np.random.default_rng(12)
    same = rng.integers(97, 123, 530_000, np.uint8).tobytes().decode()
    texts = [same + rng.integers(97, 123, 530_000, np.uint8).tobytes().decode() for _ in range(4)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(4), pa.int64()), pa.array([t.encode() for t in texts])], ["doc_id", "text"])
    assert len(list(suffix_dedup._text_of(batch).blocks())) > 3
    sent = collections.Counter((r["bucket"], r["kind"]) for b in suffix_dedup._names(4)(iter([batch])) for r in b.select([0, 1]).to_pylist())
    assert set(sent.values()) == {1} and {k for k, _ in sent} == set(range(4))
    # The same through the second step, with all names asked for.
    tagged = suffix_dedup._text_of(batch)
    texts = pa.concat_tables([pa.Table.from_batches([b]) for b in suffix_dedup._texts(1)(iter([batch]))])
    n = [int((row == i).sum()) for row in [np.concatenate([r for r, *_ in tagged.blocks()])] for i in range(4)]
    asked = suffix_dedup.batch_of([(0, 1, suffix_dedup.pack(np.repeat(suffix_dedup._short(tagged.tags), n), np.concatenate([np.arange(x, dtype=np.int32) for x in n])))])
    made = suffix_dedup._fetch(4)(texts, asked)
    sent = collections.Counter((r["bucket"], r["kind"]) for r in made.select([0, 1]).to_pylist() if r["kind"] == 4)
    assert set(sent.values()) == {1} and len(sent) == 4
    spans = [suffix_dedup.unpack(r["blob"])[:4] for t in (made, *(suffix_dedup._match(4)(made.filter(pa.compute.equal(made["bucket"], k))) for k in range(4))) for r in t.to_pylist() if r["kind"] == 3]
    gone = {i: np.zeros(1_060_000, bool) for i in range(4)}
    for ids, _, start, size in spans:
        for i, s, e in zip(ids.tolist(), start.tolist(), (start + size).tolist()):
            gone[i][s:e] = True
    assert not gone[0].any() and all(gone[i][:530_000].all() and not gone[i][530_100:].any() for i in (1, 2, 3))


@pytest.mark.parametrize("gram", [1, 7, 16, 24])
def test_segments_name_equal_windows_alike(gram):
    rng = np.random.default_rng(13)
    text = rng.integers(97, 123, 400, np.uint8)
    raw, offs = np.concatenate([text, rng.integers(97, 123, 300, np.uint8), text[100:300]]), np.array([0, 400, 700, 900])
    start, count, name = suffix_dedup.segments(raw, offs, gram=gram)
    of = {int(s) + i: k for s, c, k in zip(start, count, name.tolist()) for i in range(c)}
    assert sorted(of) == [i for a, b in ((0, 400), (400, 700), (700, 900)) for i in range(a, b - 49)]
    assert all(of[100 + i] == of[700 + i] for i in range(151))


def test_common_phrases_of_twenty_bytes_bring_no_segments_together():
    """What stands in all texts but is far shorter than the span names nothing."""
    rng = np.random.default_rng(14)
    letters = lambda n: rng.integers(97, 123, n, np.uint8)
    phrases = [letters(20) for _ in range(10)]
    raw = np.concatenate([np.concatenate([p, letters(30)]) for _ in range(40) for p in phrases])
    row_bytes = len(raw) // 40
    start, _, name = suffix_dedup.segments(raw, np.arange(41) * row_bytes)
    assert not suffix_dedup._settle(name, start // row_bytes).any()


# --- SimHash ------------------------------------------------------------------

def brute_fp(text, n=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", low) if x]
    sh = [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else [" ".join(w)] if w else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << k for k in range(64) if sum(h >> k & 1 for h in hs) * 2 > len(hs))


def test_simhash_against_brute_force(spark):
    rng = np.random.default_rng(2)
    base = [words(rng, int(n)) for n in rng.integers(1, 200, 30)]
    rows = [(i, t) for i, t in enumerate(base)] + [(100 + i, t.upper() + " Éa b") for i, t in enumerate(base[:15])]
    rows += [(200 + i, base[3] + f" tail{i}") for i in range(20)] + [(300, None), (301, ""), (302, " \t\n"), (7, base[7]), (None, base[4])]
    got = simhash.near_duplicates(docs(spark, rows)).collect()
    fp = {k: brute_fp(k) for k in {t for _, t in rows}}
    want = collections.Counter((i, fp[t]) for i, t in rows)
    assert collections.Counter((r["doc_id"], r["fp"] & (1 << 64) - 1) for r in got) == want
    codes = np.array(sorted({f for f in fp.values()}), np.uint64)
    i, j = np.nonzero(np.bitwise_count(codes[:, None] ^ codes[None]) <= 2)
    ids, root = spanning(i, j)
    least = {}
    for d, t in rows:
        c = root[np.searchsorted(codes, np.uint64(fp[t]))]
        if d is not None:
            least[c] = min(least.get(c, d), d)
    for r in got:
        c = root[np.searchsorted(codes, np.uint64(r["fp"] & (1 << 64) - 1))]
        assert r["component_id"] == least[c]


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_gray_index_finds_every_pair(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 40).astype(np.uint64)
    flips = [base ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64)) for _ in range(3)]
    code = np.unique(np.concatenate([base, *flips, flips[0] ^ np.uint64(6)]))
    bucket = np.sort(rng.integers(0, 2, len(code)))
    got = {tuple(sorted(p)) for a, b in simhash.GrayIndex(bucket, code).pairs(radius) for p in zip(a.tolist(), b.tolist())}
    d = np.bitwise_count(code[:, None] ^ code[None])
    assert got == {(i, j) for i in range(len(code)) for j in range(i + 1, len(code)) if d[i, j] <= radius and bucket[i] == bucket[j]}


# --- near-duplicate texts -------------------------------------------------------

def test_near_texts_against_brute_force(spark):
    rng = np.random.default_rng(8)
    base = [words(rng, 200, 5000) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)] + [(20 + i, t.replace(" ", "  ").upper()) for i, t in enumerate(base[:3])]
    for i, t in enumerate(base[3:9]):
        w = t.split()
        w[100] = "changed"
        rows.append((40 + i, " ".join(w)))
    rows += [(60, None), (61, ""), (62, ""), (63, "one"), (64, "one"), (None, base[0]), (5, base[5])]
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, t in rows if i is not None and t and (w := t.lower().split())}
    ids = sorted(sets)
    pairs = [(a, b) for a in ids for b in ids if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8]
    v, root = spanning(*map(np.array, zip(*pairs)))
    want = {int(x) for x, r in zip(v, root) if x != r}
    got = {r[0] for r in near_text.duplicate_ids(docs(spark, rows)).collect()}
    assert got == want
    left = near_text.keep_one(docs(spark, rows).withColumns({"gone_id": F.lit(1), "u": F.lit(2)}))
    assert left.count() == sum(i not in want for i, _ in rows) and left.columns == ["doc_id", "text", "gone_id", "u"]
    assert near_text.duplicate_ids(docs(spark, [])).count() == 0


def brute_near(rows):
    """Ids that are not the smallest of their group of five-word Jaccard of at least 0.8."""
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, t in rows if (w := t.lower().split())}
    ids = sorted(sets)
    pairs = [(a, b) for a in ids for b in ids if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8]
    v, root = spanning(*map(np.array, zip(*pairs)))
    return pairs, {int(x) for x, r in zip(v, root) if x != r}


def cut_and_appended():
    rng = np.random.default_rng(21)
    rows = []
    for i in range(60):
        base = words(rng, 100 + 5 * i, 5000).split()
        k = round(len(base) * rng.uniform(0.81, 0.84))
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(base[:k]))] if i % 2 else [(2 * i, " ".join(base[:k])), (2 * i + 1, " ".join(base[:k] + words(rng, len(base) - k, 5000).split()))]
    return rows


@pytest.mark.parametrize("hot", [None, 3])
def test_near_texts_beyond_the_radius(spark, monkeypatch, hot):
    rows = cut_and_appended()
    if hot:  # one long group of copies of which each differs from the one before, and blocks and rounds for its shingles
        rng = np.random.default_rng(22)
        w = words(rng, 120, 5000).split()
        for i in range(30):
            w[int(rng.integers(0, 120))] = f"x{i}"
            rows.append((1000 + i, " ".join(w)))
        monkeypatch.setattr(near_text, "HOT_ROWS", hot)
        monkeypatch.setattr(near_text, "OPEN_PAIRS", 1)
    pairs, want = brute_near(rows)
    text = dict(rows)
    far = [bin(near_text.word_code(text[a].encode()) ^ near_text.word_code(text[b].encode())).count("1") for a, b in pairs]
    assert sum(d > near_text.RADIUS for d in far) > 10
    assert {r[0] for r in near_text.duplicate_ids(docs(spark, rows)).collect()} == want


def test_near_texts_read_only_open_buckets_again(spark, monkeypatch):
    """A crowded shingle takes rounds; the buckets that the first one settled are not read by a later one."""
    rng = np.random.default_rng(25)
    crowd = words(rng, 5, 5000)
    rows = [(i, crowd + " " + words(rng, 40, 5000)) for i in range(60)]
    for g in range(8):  # groups of texts that differ in few words, in buckets of four to six
        w = words(rng, 60, 5000).split()
        for i in range(6):
            rows.append((100 + 10 * g + i, " ".join(w[: 52 + i] + words(rng, 8 - i, 5000).split())))
    read, meet = [], near_text._meet
    monkeypatch.setattr(near_text, "OPEN_PAIRS", 4)
    monkeypatch.setattr(near_text, "prefix", lambda names, counts, similarity: names[np.argsort(names)])  # every shingle, so that the crowded one takes part
    monkeypatch.setattr(near_text, "_meet", lambda large, *more: read.append({(r[0], r[1]) for r in large.groupBy("k").count().collect()}) or meet(large, *more))
    got = {r[0] for r in near_text.duplicate_ids(docs(spark, rows)).collect()}
    assert got == brute_near(rows)[1]
    assert len(read) > 1 and max(n for _, n in read[0]) == 60 and len(read[0]) > 10
    assert all(b < a for a, b in zip(read[:1], read[1:])) and all(n > 8 for _, n in read[1])


def test_near_texts_with_repeated_ids(spark):
    rng = np.random.default_rng(41)
    a, b = words(rng, 80, 5000), words(rng, 80, 5000)
    low, high = sorted([a, b])
    rows = [(5, low), (5, high), (5, high), (7, high + " more"), (8, low + " more"), (9, "x"), (9, "x")]
    assert {r[0] for r in near_text.duplicate_ids(docs(spark, rows)).collect()} == {8}
    assert sorted(r["doc_id"] for r in near_text.keep_one(docs(spark, rows)).collect()) == [5, 5, 5, 7, 9, 9]


def test_near_texts_of_one_code(spark):
    """The smallest id of a code is unlike the others, of which two are alike."""
    rng = np.random.default_rng(24)
    base = [f"w{i}" for i in range(200)]
    other = rng.permutation(base).tolist()
    rows = [(1, " ".join(base)), (2, " ".join(other)), (3, " ".join(other + other[:1]))]
    assert len({near_text.word_code(t.encode()) for _, t in rows}) == 1
    pairs, want = brute_near(rows)
    assert pairs == [(2, 3)]
    assert {r[0] for r in near_text.duplicate_ids(docs(spark, rows)).collect()} == want


def test_bucket_pairs_lose_no_pair():
    rng = np.random.default_rng(23)
    sets = [np.unique(rng.integers(0, 1 << 63, 60).astype(np.uint64)) for _ in range(40)]
    sets += [np.unique(np.concatenate([s[: 60 - k], rng.integers(0, 1 << 63, k // 2).astype(np.uint64)])) for s in sets for k in (3, 6, 9, 12)]
    counts = rng.integers(0, 9, 1 << near_text.COUNT_BITS).astype(np.uint32)
    first = [near_text.prefix(s, counts, 0.8) for s in sets]
    n = np.array([len(p) for p in first])
    ids, k = np.repeat(np.arange(len(sets)), n), np.concatenate(first)
    pos, size = np.concatenate([np.arange(x) for x in n]), np.repeat([len(s) for s in sets], n)
    maps = np.frombuffer(b"".join(near_text.fold(s) for s in sets), np.uint64).reshape(len(sets), -1)[ids]
    got = {p for u, v, whole in near_text.bucket_pairs(k, ids, ids, size, pos, 0.8, float("inf")) if whole for p in zip(u.tolist(), v.tolist())}
    fewer = {p for u, v, whole in near_text.bucket_pairs(k, ids, ids, size, pos, 0.8, float("inf"), maps) if whole for p in zip(u.tolist(), v.tolist())}
    want = {(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets)) if near_text.jaccard(sets[a], sets[b]) >= 0.8}
    prev = np.concatenate([np.concatenate((p[:1], p[:-1])) for p in first])
    once = [p for u, v, whole in near_text.bucket_pairs(k, ids, ids, size, pos, 0.8, float("inf"), maps, prev) if whole for p in zip(u.tolist(), v.tolist())]
    assert len(want) > 40 and want <= fewer <= got and want <= set(once) and len(once) < 3 * len(set(once))
    for a, b in want:
        far = np.bitwise_count(near_text.bitmap(sets[a]) ^ near_text.bitmap(sets[b])).sum()
        assert far <= len(sets[a]) + len(sets[b]) - 2 * len(np.intersect1d(sets[a], sets[b]))


def test_words_and_shingles_against_splitting(monkeypatch):
    from tracewright.llm import shingling

    rng = np.random.default_rng(31)
    texts = [*(t.encode() for t in ODD), b"", b"   ", b"a", b" lead", b"trail \x0b\x0c", b"MiXed Case mixed case", *(words(rng, int(n), 40).encode() for n in rng.integers(0, 60, 40)), b"long" * 300]
    raw, offs = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    for window in (1 << 20, 64, 7):
        monkeypatch.setattr(shingling, "WINDOW", window)
        names, n = shingling.words_of(raw, offs)
        assert n.tolist() == [len(t.lower().split()) for t in texts]
        seen = {}
        for w, x in zip((w for t in texts for w in t.lower().split()), names.tolist(), strict=True):
            assert seen.setdefault(w, x) == x
        assert len(set(seen.values())) == len(seen)
        flat, sizes = shingling.shingle_sets(raw, offs, 5)
        ends, known = np.concatenate(([0], np.cumsum(sizes))), {}
        for i, t in enumerate(texts):
            w = t.lower().split()
            want = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
            assert len(want) == sizes[i]
            got = near_text.shingle_set(t, 5)
            assert got.tolist() == flat[ends[i] : ends[i + 1]].tolist() and (np.diff(got.astype(object)) > 0).all()
            known |= dict.fromkeys(got.tolist()) | {}
        codes = shingling.codes_of(*shingling.distinct(names, n))
        at = np.concatenate(([0], np.cumsum(n)))
        assert codes.tolist() == [simhash.majority(np.unique(names[s:e])) for s, e in zip(at[:-1], at[1:])]
    high, low = shingling.digests_of(names, n)
    same = {}
    for t, h, x in zip(texts, high.tolist(), low.tolist(), strict=True):
        same.setdefault(b" ".join(t.lower().split()), set()).add((h, x))
    assert all(len(v) == 1 for v in same.values()) and len({next(iter(v)) for v in same.values()}) == len(same)


@pytest.mark.parametrize("rows", [10_000, 3, 1])
def test_buckets_of_sorted_rows(spark, rows):
    sets = {1: [5, 9, 7], 2: [5, 7], 3: [8], -4: [7], 6: [7]}
    df = spark.createDataFrame([(i, 10 + abs(i), bytearray(np.array(x, np.uint64).tobytes())) for i, x in sets.items()], "id long, size int, names binary")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    got = sorted((r["k"], r["at"] >> 32, r["id"], r["first"], r["before"], r["turn"]) for r in near_text._buckets(df.coalesce(1)).collect())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == [(5, 11, 1, 1, None, 0), (5, 12, 2, 1, 1, 1), (7, 11, 1, 1, None, 0), (7, 12, 2, 1, 1, 1), (7, 14, -4, 1, 2, 2), (7, 16, 6, 1, -4, 3)]


def test_forest_is_minimal():
    u, v, d = np.array([1, 2, 1, 3]), np.array([2, 3, 3, 4]), np.array([3, 1, 2, 0])
    assert near_text.forest(u, v, d).tolist() == [1, 2, 3]


def test_choices_cover_every_pair():
    rng = np.random.default_rng(4)
    for n in (10, 10**6, 10**9):
        tables = near_text.choices(n, 6)
        for _ in range(50):
            x = int(rng.integers(0, 1 << 62))
            y = x
            for b in rng.choice(64, 6, replace=False):
                y ^= 1 << int(b)
            assert any(all((x >> s) & (1 << w) - 1 == (y >> s) & (1 << w) - 1 for s, w in t) for t in tables)


# --- tokens and pieces ----------------------------------------------------------

ODD = ["  a  b ", "a\n\nb\t c", "", "don't stop   \n", "x <|endoftext|> y", "ﬁ ½ Ａ", "a\x1c b \x1f c", "é à  ü 😀 z", "1 2  33  x"]


def test_token_counts_equal_the_library(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(token_counts.vocabulary_path("byte_bpe_50k.json"))
    rng = np.random.default_rng(0)
    texts = [*ODD, "".join(rng.choice(list("ab \n.é1"), 5000)), "word " * 40_000, "a" * 70_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(98, None), (None, "hello")]
    got = by_id(token_counts.count_tokens(docs(spark, rows).withColumn("n_tokens", F.lit("clash"))))
    for i, t in rows:
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        assert (got[i]["n_tokens"], got[i]["n_bytes"], got[i]["over_limit"]) == (n, len((t or "").encode()), n > 512)
    assert token_counts.count_tokens(docs(spark, [])).count() == 0


def test_other_vocabularies(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=token_counts.vocabulary_path("piece_bpe_32k.model"))
    got = by_id(token_counts.count_tokens(docs(spark, list(enumerate(ODD))), "piece_bpe_32k.model"))
    assert [got[i]["n_tokens"] for i in range(len(ODD))] == [len(x) for x in model.encode(ODD)]


def test_pieces_without_dropout_equal_the_library():
    import sentencepiece

    path = token_counts.vocabulary_path("piece_bpe_32k.model")
    texts = [*ODD, "the quick brown fox " * 30, "<s> x </s>"]
    coder = pieces.Pieces(path, dropout=0.0)
    assert coder.encode(texts, [0] * len(texts)) == sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)


def slow_pieces(coder, text, start, seed, dropout):
    """Piece ids by one agenda per word that looks at every pair anew after each merge."""
    import sentencepiece
    import xxhash

    model = sentencepiece.SentencePieceProcessor(model_file=token_counts.vocabulary_path("piece_bpe_32k.model"))
    full = 2**64 - 1

    def mix(h):
        h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 & full
        h = (h ^ h >> 27) * 0x94D049BB133111EB & full
        return h ^ h >> 31

    ids = {model.id_to_piece(i): i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
    spelt = {z: model.piece_to_id(f"<0x{z:02X}>") for z in range(256)}
    out = []
    for turn, word in enumerate(coder.words(text)):
        key = mix(mix(xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) ^ seed) ^ mix(mix(start) + turn + 1 & full))
        parts = [(i, c) for i, c in enumerate(word)]
        while True:
            best = None
            for n in range(len(parts) - 1):
                made = ids.get(parts[n][1] + parts[n + 1][1])
                if made is None or parts[n][1] not in ids or parts[n + 1][1] not in ids:
                    continue
                if mix(key + (parts[n][0] << 42) + (parts[n + 1][0] << 21) + made & full) >> 32 < dropout * 2**32:
                    continue
                if best is None or (-model.get_score(made), n) < best:
                    best = (-model.get_score(made), n)
            if best is None:
                break
            n = best[1]
            parts[n : n + 2] = [(parts[n][0], parts[n][1] + parts[n + 1][1])]
        for _, x in parts:
            out += [ids[x]] if x in ids else [spelt[z] for z in x.replace("\ud800", "\u2581").encode()]
    return out


MARKED = ["x\u2581y a", "\u2581", " \u2581\u2581 b", "a \u2581b"]


@pytest.mark.parametrize(("dropout", "long"), [(0.1, 64), (0.5, 64), (0.5, 3), (1.0, 64)])
def test_dropout_against_brute_force(monkeypatch, dropout, long):
    monkeypatch.setattr(pieces, "LONG", long)
    monkeypatch.setattr(pieces, "MEMORY", 100)
    monkeypatch.setattr(pieces, "AT_ONCE", 50)
    coder = pieces.Pieces(token_counts.vocabulary_path("piece_bpe_32k.model"), dropout, 9)
    texts = [*ODD, *MARKED, "the international organisation of standards and the the the " * 6, "donaudampfschifffahrtsgesellschaft" * 4]
    got = coder.encode(texts, list(range(len(texts))))
    for i, (t, g) in enumerate(zip(texts, got, strict=True)):
        if len(t) < 2000:
            assert g == slow_pieces(coder, t, i, 9, dropout), t
        assert coder.decode(g) == t


def test_long_words_take_linear_time():
    import time

    coder = pieces.Pieces(token_counts.vocabulary_path("piece_bpe_32k.model"), 0.1, 1)
    word = "".join(np.random.default_rng(0).choice(list("etaoinshrdlu"), 200_000))
    coder.encode(["warm" * 40], [0])
    began = time.process_time()
    assert coder.decode(coder.encode([word[:50_000]], [3])[0]) == word[:50_000]
    middle = time.process_time()
    assert coder.decode(coder.encode([word], [3])[0]) == word
    assert time.process_time() - middle < 12 * (middle - began)


def test_dropout_is_drawn_per_occurrence():
    coder = pieces.Pieces(token_counts.vocabulary_path("piece_bpe_32k.model"), dropout=0.4)
    text = " ".join(["internationally"] * 40)
    got = coder.encode([text], [7])[0]
    cuts, word = set(), []
    for x in got:
        if coder.names[x].startswith("\u2581") and word:
            cuts.add(tuple(word))
            word = []
        word.append(x)
    assert len(cuts) > 15 and coder.decode(got) == text


def test_pieces_of_odd_tables(spark):
    from pyspark.sql import functions as F

    rows = [(1, "the same text"), (1, "the same text"), (None, "no id"), (None, "no id"), (2, None), (3, ""), (4, "word " * 3000 + "x" * 70_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"pieces": F.lit("clash"), "decoded": F.lit(1), "lossless": F.lit(0)})
    got = pieces.encode_pieces(df, dropout=0.3).collect()
    assert sorted((r["doc_id"] or 0, r["decoded"]) for r in got) == sorted((i or 0, t or "") for i, t in rows)
    assert all(r["lossless"] for r in got)
    assert len({tuple(r["pieces"]) for r in got if r["doc_id"] == 1}) == 1 and [r["pieces"] for r in got if r["doc_id"] in (2, 3)] == [[], []]
    assert pieces.encode_pieces(df.limit(0)).count() == 0


def test_dropout_varies_and_decodes(spark):
    texts = [*ODD, "international organisation of standards " * 20]
    one, two = ([tuple(r["pieces"]) for r in pieces.encode_pieces(docs(spark, list(enumerate(texts))), dropout=0.4, seed=s).orderBy("doc_id").collect()] for s in (1, 2))
    again = [tuple(r["pieces"]) for r in pieces.encode_pieces(docs(spark, list(enumerate(texts))), dropout=0.4, seed=1).orderBy("doc_id").collect()]
    assert one == again and one[-1] != two[-1]
    got = by_id(pieces.encode_pieces(docs(spark, [*enumerate(texts), (50, None)]), dropout=0.4))
    assert all(got[i]["decoded"] == t for i, t in enumerate(texts)) and got[50]["pieces"] == []
    full = pieces.Pieces(token_counts.vocabulary_path("piece_bpe_32k.model"), dropout=1.0).encode(["abc"], [0])[0]
    assert len(full) == 4


# --- packing --------------------------------------------------------------------

def test_bounds_are_optimal():
    rng = np.random.default_rng(1)
    from itertools import combinations

    for n in (1, 2, 5, 8):
        lengths = np.sort(rng.choice(50, n, replace=False)) + 1
        counts = rng.integers(1, 20, n)
        for k in (1, 2, 3, 9):
            cost = lambda ends: sum(c * (min(e for e in ends if e >= x) - x) for x, c in zip(lengths, counts))
            best = min(cost([*c, lengths[-1]]) for r in range(min(k, n)) for c in combinations(lengths[:-1], r))
            ends = packing.optimal_bounds(lengths, counts, k)
            assert len(ends) <= k and ends[-1] == lengths[-1] and cost(ends) == best


def test_packing_counts_tokens(spark):
    rows = [*enumerate(ODD), (100, None), (None, "no id")]
    want = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"]) for r in token_counts.count_tokens(docs(spark, rows)).collect())
    got = packing.pack(docs(spark, rows), tokenizer="byte_bpe_50k.json").collect()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"]) for r in got) == want
    assert all(r["n_padding"] == r["bucket_len"] - r["n_tokens"] >= 0 for r in got)


def test_batches_fit_the_budget(spark):
    rng = np.random.default_rng(2)
    rows = [(i, words(rng, int(n))) for i, n in enumerate(rng.integers(0, 90, 120))] + [(200, None), (201, ""), (None, "a b"), (3, "x"), (300, "w " * 500)]
    got = packing.pack(docs(spark, rows), buckets=4, budget=200).collect()
    assert sorted(r["n_tokens"] for r in got) == sorted(len((t or "").split()) for _, t in rows)
    per = collections.defaultdict(list)
    for r in got:
        assert r["n_tokens"] + r["n_padding"] == r["bucket_len"]
        per[r["bucket"], r["batch"]].append(r)
    for (b, _), rs in per.items():
        assert b == 0 or len(rs) * rs[0]["bucket_len"] <= 200 or len(rs) == 1
    for b in {b for b, _ in per}:
        sizes = [len(per[b, k]) for k in range(max(k for x, k in per if x == b) + 1)]
        assert len(set(sizes[:-1])) <= 1
    assert packing.pack(docs(spark, [])).count() == 0


# --- WARC -----------------------------------------------------------------------

@pytest.mark.parametrize("version", [1, 2])
def test_arc_round_trip(version):
    bodies = [("http://a/ b", "text/html", b"HTTP/1.1 200 OK\r\nX: 1\r\n\r\n<p>\n\r\n\r\n"), ("http://b/", "text/plain", b"plain"), ("http://c/", "text/html", b"")]
    got = list(warc.read_arc(warc.write_arc(bodies, version)))
    assert got[0].header["url"].startswith("filedesc:") and [r.content for r in got[1:]] == [b for *_, b in bodies]
    new = [warc.to_warc(r) for r in got]
    assert [r.headers["WARC-Type"] for r in new] == ["warcinfo", "response", "resource", "resource"]
    assert new[1].payload == b"<p>\n\r\n\r\n" and new[1].headers["WARC-Date"] == "2024-01-01T00:00:00Z"
    data = b"".join(warc.member(r) for r in new)
    back = list(warc.read_warc(data))
    assert [(r.headers["WARC-Record-ID"], r.block) for r in back] == [(r.headers["WARC-Record-ID"], r.block) for r in new]


def test_arc_errors():
    with pytest.raises(ValueError):
        list(warc.read_arc(warc.write_arc([("http://a", "t/x", b"abc")], 1)[:-3]))
    with pytest.raises(ValueError):
        list(warc.read_arc(warc.write_arc([], 1).replace(b"1 0 tracewright", b"3 0 tracewright")))


@pytest.mark.parametrize("least", [0, 4])
def test_pages_against_brute_force(spark, least):
    rows = [(1, "u", "same text"), (5, "u v", "same text"), (3, None, "same text"), (2, "u", ""), (4, "u", None), (6, "u", "\r\n\r\né"), (6, "u", "\r\n\r\né"), (7, "u", "abc"), (8, "u", "abc"), (None, "u", "abc"), (None, "u", "lone")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"refers_to": F.lit("clash"), "sha": F.lit(1)})
    got = warc.archive_pages(df, min_bytes=least).collect()
    best = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= least:
            best[h or ""] = max(best.get(h or "", i), i)
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        to = best.get(h or "")
        to = None if to == i else to
        want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if to is None else "revisit", to))
    assert sorted(map(repr, ((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got))) == sorted(map(repr, want))
    assert warc.archive_pages(df.limit(0)).count() == 0


# --- classifiers ------------------------------------------------------------------

def brute_edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_automaton_against_edit_distance():
    rng = np.random.default_rng(6)
    terms = ["idiot", "scum", "pathetic", "moron", "worthless"]
    a = toxicity.Automaton(terms, ["lowei"])
    tries = set(terms) | {"idiott", "idot", "1diot", "skum", "pathtic", "phatetic", "worhtles", "loweiabc", "loweX", "lowe", ""}
    for t in terms:
        for _ in range(60):
            w = list(t)
            for _ in range(rng.integers(1, 4)):
                k = rng.integers(0, len(w))
                w[k : k + 1] = rng.choice(["", "a", "s", w[k] + "x"], 1)[0]
                w = w or ["a"]
            tries.add("".join(w))
    for w in tries:
        best = min(((brute_edit(w, t), t) for t in terms if brute_edit(w, t) <= toxicity.edits_for(t)), default=None)
        want = ("lowei*", 0) if w.startswith("lowei") else (best[1], best[0]) if best else None
        assert a.find(w) == want, w


def test_quotation_is_told_apart():
    s = toxicity.Scanner(toxicity.Automaton(["idiot"], []))
    assert s.scan("you are an idiot !")[1] == [("idiot", 0, False, True)]
    assert s.scan('the text has "idiot" in it')[1] == [("idiot", 0, True, False)]
    assert s.scan("he wrote idiot there")[1] == [("idiot", 0, True, False)]
    assert s.scan("")[1] == []


def labelled(spark, n=400):
    rng = np.random.default_rng(9)
    rows, labels = [], []
    for i in range(n):
        bad, toxic = i % 4 == 0, i % 5 == 0
        w = [f"x{k}" for k in rng.integers(0, 300, 60)]
        if bad:
            w = [x.upper() + "!!" for x in w[:20]] * 3
        if toxic:
            for _ in range(3):
                w[rng.integers(0, 60)] = rng.choice(["idiot", "idjot", "moron,"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(not bad), int(toxic)))
    return docs(spark, rows + [(1000, None), (1001, ""), (None, "x1"), (3, rows[3][1])]), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("run,label,limit", [(quality.score_quality, "quality", 0.3), (toxicity.score_toxicity, "toxic", 0.5)])
def test_classifiers_on_held_out_rows(spark, run, label, limit):
    d, lab = labelled(spark)
    got = run(d.withColumns({"score": F.lit("clash"), "label": F.lit(1)}), lab).collect()
    assert len(got) == d.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= limit) for r in got)
    truth = {r["doc_id"]: r[label] for r in lab.collect()}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert all(fold_of(r["doc_id"]) == 0 for r in held) and all(fold_of(r["doc_id"]) for r in got if not r["held_out"] and r["doc_id"] is not None)
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) >= 0.95
    again = run(d, lab).collect()
    assert sorted((repr(r["doc_id"]), r["score"]) for r in got) == sorted((repr(r["doc_id"]), r["score"]) for r in again)


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_toxicity_scores_against_brute_force(spark):
    d, lab = labelled(spark)
    model = toxicity.fit(d, lab)
    terms, stems = model.scanner.automaton.terms, model.scanner.automaton.stems
    assert terms or stems
    texts = [*(r["text"] or "" for r in d.collect()), "You idiiot! said he", '"idiot" she wrote', "midiot " * 9, "x " * 20_000 + "moron"]
    for t, score in zip(texts, model.score(texts).tolist(), strict=True):
        words_, hits = t.lower().split(), []
        for i, w in enumerate(words_):
            c = toxicity.clean(w)
            found = min(((len(x), x + "*", 0) for x in stems if c.startswith(x)), default=None)
            found = found and found[1:] or min(((e, x) for x in terms if (e := edit_distance(c, x)) <= toxicity.edits_for(x)), default=None)
            if found:
                term, e = found if isinstance(found[0], str) else found[::-1]
                near = {toxicity.clean(x) for x in words_[max(0, i - toxicity.WINDOW) : i + toxicity.WINDOW + 1]}
                before = sum(x in toxicity.QUOTES for y in words_[:i] for x in y)
                quoted = before % 2 == 1 or any(x in toxicity.QUOTES for x in w) or bool(near & toxicity.REPORTS)
                hits.append((model.weight.get((term, e), model.base[e]), quoted, bool(near & toxicity.PERSONS)))
        opened, quotes = [x for x, q, _ in hits if not q], [x for x, q, _ in hits if q]
        x = [1, max(opened, default=0), np.log1p(sum(opened)), max(quotes, default=0), max((w for w, _, p in hits if p), default=0), (len(hits) / len(words_)) ** 0.5 if words_ else 0]
        assert abs(score - 1 / (1 + np.exp(-np.clip(np.dot(x, model.beta), -40, 40)))) < 1e-9


def test_quality_scores_against_brute_force(spark):
    d, lab = labelled(spark)
    model = quality.fit(d, lab)
    texts = {r["doc_id"]: r["text"] or "" for r in d.collect()}
    got = by_id(quality.score_quality(d, lab))
    for i, t in texts.items():
        w, total = t.split(), np.zeros(model.vectors.shape[1])
        for x in w:
            n = model.words.number.get(x)
            total += model.vectors[model.words.number.get(quality.shape(x), 0) if n is None else n]
        times = np.array(list(collections.Counter(w).values()), float)
        f = np.concatenate([total / max(1, len(w)), [np.sqrt((times**2).sum()) / max(1, len(w)), np.log1p(len(w))]])
        z = np.tanh((f - model.mean) / model.scale @ model.w1 + model.b1) @ model.w2 + model.b2
        assert abs(got[i]["score"] - 1 / (1 + np.exp(-z / model.temperature))) < 1e-5


@pytest.mark.parametrize("keep,run,good", [(quality.filter_quality, quality.score_quality, lambda s: s >= 0.3), (toxicity.filter_toxicity, toxicity.score_toxicity, lambda s: s < 0.5)])
def test_filters_keep_odd_rows_whole(spark, keep, run, good):
    d, lab = labelled(spark)
    odd = d.unionByName(docs(spark, [(7, "idiot " * 50), (7, "idiot " * 50), (None, None), (None, ""), (8, "y " * 50_000)])).withColumns({"score": F.lit("clash"), "label": F.lit(1), "n": F.lit(2)})
    scores = collections.Counter((r["doc_id"], good(r["score"])) for r in run(odd, lab).collect())
    left = keep(odd, lab)
    assert left.columns == odd.columns and collections.Counter(r["doc_id"] for r in left.collect()) == {i: n for (i, ok), n in scores.items() if ok}
    assert keep(odd.limit(0), lab).count() == 0 and keep(odd, lab.limit(0)).count() == odd.count()


@pytest.mark.parametrize("run,label", [(quality.score_quality, "quality"), (toxicity.score_toxicity, "toxic")])
def test_classifiers_without_labels_or_rows(spark, run, label):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert len({r["score"] for r in run(docs(spark, [(1, "a"), (2, None)]), none).collect()}) == 1
    d, lab = labelled(spark, 20)
    assert run(docs(spark, []), lab).count() == 0
    assert run(d, lab.filter(F.col(label) == 1)).count() == d.count()


def test_archives_are_read_in_linear_time():
    record = warc.to_warc(next(warc.read_arc(warc.write_arc([], 1))))
    one = warc.member(record)
    fed = []

    class Counting:
        def __init__(self, d):
            self.d = d

        def decompress(self, part):
            fed.append(len(part))
            return self.d.decompress(part)

        eof = property(lambda self: self.d.eof)
        unused_data = property(lambda self: self.d.unused_data)

    make = warc.zlib.decompressobj
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(warc.zlib, "decompressobj", lambda bits: Counting(make(bits)))
        assert len(list(warc.read_warc(one * 500))) == 500
    assert max(fed) <= warc.FEED and sum(fed) <= 500 * (warc.FEED + len(one))
    with pytest.raises(ValueError):
        list(warc.members((one * 3)[:-4]))


def test_revisits_state_the_page_that_they_refer_to():
    record = warc.to_warc(list(warc.read_arc(warc.write_arc([("http://a", "text/html", b"HTTP/1.1 200 OK\r\n\r\nx")], 2)))[1])
    revisit = warc.to_revisit(record, 7)
    assert warc.referred_page(revisit.headers) == 7
    assert warc.referred_page(revisit.headers | {"WARC-Refers-To": warc.page_record_id(8)}) is None


def test_hot_payloads_get_their_role(spark):
    from tracewright.llm.common import join_hot

    rows = [(i, "same" if i % 3 else f"{i % 50}") for i in range(600)] + [(None, "same"), (None, "same"), (7, "same")]
    got = warc.roles(spark.createDataFrame(rows, "page_id long, html string").selectExpr("page_id", "'u' as url", "html")).collect()
    last = {}
    for i, h in rows:
        last[h] = max(last.get(h, -1), -1 if i is None else i)
    assert sorted((r["page_id"] or -1, bytes(r["html"]).decode(), r["refers_to"]) for r in got) == sorted((i or -1, h, None if i == last[h] else last[h]) for i, h in rows)
    side = spark.createDataFrame([("a", 90, 1), ("b", 5, 2), ("c", 5, 3)], "k string, n long, x int")
    left = spark.createDataFrame([(k,) for k in "a" * 90 + "b" * 5 + "c" * 5 + "d"], "k string")
    for parts in (1, 4, 1000):
        assert sorted(map(tuple, join_hot(left, side, "k", parts).groupBy("k", "x").count().collect())) == [("a", 1, 90), ("b", 2, 5), ("c", 3, 5)]
