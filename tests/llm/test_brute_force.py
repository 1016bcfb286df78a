"""Operators against brute force on the whole small documents table."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.cases import AZ, SMALL, shingle_set, small_docs, spaced
from tidemark.llm import decontaminate, lz_fingerprint, minhash_dedup, mixing, passages, pii, queries, run_index, store, token_files


@pytest.fixture(scope="module")
def texts(spark):
    return dict(small_docs(spark).select("doc_id", "text").collect())


def _by_id(df):
    return df.toPandas().set_index("doc_id")


def test_decontamination(spark, texts):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(AZ))
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text")
    some = cut(texts[3])
    items = items.union(spark.createDataFrame([(900, " ".join(some[4:7])), (901, some[0]), (902, " ".join(some[2:14]))], items.schema))
    windows = defaultdict(set)
    for i, t in items.collect():
        w = cut(t)
        for p in range(max(1, len(w) - 9)):
            windows[tuple(w[p:p + 10])].add(i)
    got = _by_id(decontaminate.contaminated_words(small_docs(spark), items))
    for doc_id, t in texts.items():
        w, hit, found = cut(t), set(), set()
        for n in {len(k) for k in windows}:
            for p in range(len(w) - n + 1):
                if ids := windows.get(tuple(w[p:p + n])):
                    hit.update(range(p, p + n))
                    found |= ids
        r = got.loc[doc_id]
        assert (r["n_words"], r["n_hit"], list(r["items"])) == (len(w), len(hit), sorted(map(str, found)))


def test_winnowing_keeps_a_gram_of_every_span():
    values = np.array([5, 3, 3, 9, 1, 1, 1, 7, 8, 2, 6], np.uint64)
    kept = set(decontaminate.winnowed(values, 4).tolist())
    assert all(kept & set(range(i, i + 4)) for i in range(len(values) - 3))


def _components(links, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def _links(sets):
    meet = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            meet[g].append(i)
    pairs = {(a, b) for ids in meet.values() for a in ids for b in ids if a < b}
    return [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]


def test_near_duplicates(spark, texts):
    sets = {i: shingle_set(t) for i, t in texts.items()}
    want = _components(_links(sets), sets)
    got = _by_id(minhash_dedup.near_duplicates(small_docs(spark)))
    assert got["component_id"].to_dict() == want
    assert got["n_shingles"].to_dict() == {i: len(s) for i, s in sets.items()}


def test_one_id_with_several_texts(spark):
    """Rows that share a doc_id are one node: the groups of all its texts meet."""
    from tests.llm.cases import words
    texts = [" ".join(words(60, s)) for s in range(4)]
    rows = [(5, texts[0]), (5, texts[1]), (5, texts[2]), (7, texts[0]), (6, texts[1]), (9, texts[2] + " tail"), (8, texts[3])]
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(5, 5), (5, 5), (5, 5), (6, 5), (7, 5), (8, 8), (9, 5)]


def test_link_between_members_far_from_the_pivot(spark):
    """A chain: each text is near the next one only, so no bucket's smallest
    member is linked with all."""
    base = [f"w{i}" for i in range(400)]
    rows = []
    for step in range(12):
        w = base.copy()
        for j in range(step):
            for p in range(6):
                w[j * 30 + p * 5] = f"x{j}_{p}"
        rows.append((100 - step, " ".join(w)))
    rows += [(200 + i, " ".join(base[:300] + [f"y{i}_{j}" for j in range(100)])) for i in range(8)]
    sets = {i: shingle_set(t) for i, t in rows}
    want = _components(_links(sets), sets)
    got = _by_id(minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert len(set(want.values())) > 1 and got["component_id"].to_dict() == want


@pytest.mark.parametrize("hot", [2048, 1])
def test_repeated_bytes(spark, texts, monkeypatch, hot):
    monkeypatch.setattr(run_index, "HOT", hot)
    raw = {i: t.encode() for i, t in texts.items()}
    seen = Counter(b[p:p + 400] for b in raw.values() for p in range(len(b) - 399))
    got = _by_id(run_index.without_repeats(small_docs(spark)))
    for doc_id, b in raw.items():
        gone = bytearray(len(b))
        for p in range(len(b) - 399):
            if seen[b[p:p + 400]] > 1:
                gone[p:p + 400] = b"\1" * 400
        spans = sum(1 for p in range(len(b)) if gone[p] and not (p and gone[p - 1]))
        r = got.loc[doc_id]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(b), sum(gone), spans)
        assert bytes(r["kept"]) == bytes(c for c, x in zip(b, gone) if not x)


def test_matching_statistics():
    rng = np.random.default_rng(4)
    for _ in range(60):
        parts = [bytes(rng.choice(list(b"ab"), rng.integers(1, 25)).tolist()) for _ in range(rng.integers(1, 6))]
        offs = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        suffixes = [(o + i, p[i:]) for o, p in zip(offs, parts) for i in range(len(p))]

        def common(a, b):
            n = 0
            while n < min(len(a), len(b)) and a[n] == b[n]:
                n += 1
            return n

        want = [max((common(s, t) for j, t in suffixes if j != i), default=0) for i, s in suffixes]
        assert run_index.matching_statistics(np.frombuffer(b"".join(parts), np.uint8), offs).tolist() == want


def test_long_text_in_pieces(monkeypatch):
    rng = np.random.default_rng(5)
    data = rng.integers(97, 101, 9000).astype(np.uint8)
    offs = np.array([0, 200, 9000])
    whole = run_index.contexts(data, offs)
    monkeypatch.setattr(run_index, "_PIECE", 700)
    parts = run_index.contexts(data, offs)
    cover = lambda c: sorted(w for t, a, b in zip(*c[:3]) for w in range(a, b + 1))
    assert cover(whole) == cover(parts) == list(range(8800 - 399))
    assert set(whole[3]) == set(parts[3])


def test_compact_windows_cover_each_passage_once():
    rng = np.random.default_rng(6)
    for _ in range(50):
        n, least = int(rng.integers(1, 60)), int(rng.integers(1, 8))
        v = (rng.integers(0, 1 << 30, n).astype(np.uint64) << np.uint64(24)) | np.arange(n, dtype=np.uint64)
        seen = Counter()
        for left, c, right in zip(*passages.compact_windows(v, least)):
            for i in range(left, c + 1):
                for j in range(c, right + 1):
                    seen[i, j] += 1
                    assert v[i:j + 1].argmin() + i == c
        assert all(seen[i, j] == 1 for i in range(n) for j in range(i + least - 1, n))


def test_repeated_passages(spark, texts):
    """Every word of a 50-word run that another document has is reported; what
    is reported resembles a passage elsewhere."""
    docs = {i: spaced(t) for i, t in texts.items()}
    owners = defaultdict(set)
    for i, w in docs.items():
        for p in range(len(w) - 49):
            owners[tuple(w[p:p + 50])].add(i)
    got = _by_id(passages.near_passages(small_docs(spark)))
    for i, w in docs.items():
        told = np.zeros(len(w), bool)
        for s in filter(None, got.loc[i, "spans"].split(",")):
            a, b = map(int, s.split(":"))
            assert b - a >= 50
            told[a:b] = True
        for p in range(len(w) - 49):
            if len(owners[tuple(w[p:p + 50])]) > 1:
                assert told[p:p + 50].all(), (i, p)
    assert (got["n_spans"] > 0).any() and (got["n_spans"] == 0).any()


def test_edited_passage_is_found(spark):
    from tests.llm.cases import words
    shared = words(120, 1)
    edited = shared.copy()
    edited[60] = "changed"
    rows = [(1, " ".join(words(200, 2) + shared)), (2, " ".join(edited + words(100, 3))), (3, " ".join(words(300, 4)))]
    got = _by_id(passages.near_passages(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got["spans"].to_dict() == {1: "200:320", 2: "0:120", 3: ""}
    assert got["class_id"].to_dict() == {1: 1, 2: 1, 3: 3} and got["n_links"].to_dict() == {1: 1, 2: 1, 3: 0}


EDITED = [(50, (25,)), (60, (30,)), (75, (25,)), (90, (30, 60)), (150, (30, 100, 125)), (50, (2,))]


def test_edited_passages_are_whole(spark):
    """Passages of 0.75 and more, each run of equal shingles short."""
    from tests.llm.cases import words
    rows, want = [], {}
    for k, (n, places) in enumerate(EDITED):
        shared = words(n, 50 + k)
        edited = [f"changed{p}" if p in places else w for p, w in enumerate(shared)]
        rows += [(2 * k, " ".join(words(70, 100 + k) + shared)), (2 * k + 1, " ".join(edited + words(90, 150 + k)))]
        want |= {2 * k: f"70:{70 + n}", 2 * k + 1: f"0:{n}"}
    got = _by_id(passages.near_passages(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got["spans"].to_dict() == want
    assert got["class_id"].to_dict() == {i: i // 2 * 2 for i in want} and set(got["n_links"]) == {1}


def test_passages_cover_what_brute_force_covers():
    """Every stretch that passes and ends at shared shingles is covered; with
    substituted words passages lie on one diagonal."""
    rng = np.random.default_rng(11)
    own = lambda w, *x: passages._Own(w.astype(np.uint64), *x)
    for _ in range(60):
        n, lead = int(rng.integers(50, 151)), int(rng.integers(0, 40))
        a = rng.integers(1, 1 << 60, lead + n + 30)
        b = a.copy()
        b[:lead], b[lead + n:] = rng.integers(1, 1 << 60, lead), rng.integers(1, 1 << 60, 30)
        at = lead + rng.integers(0, n, int(rng.integers(1, 5)))
        b[at] = rng.integers(1, 1 << 60, len(at))
        x, y = own(a), own(b, False)
        same = x.seq == y.seq
        total = np.concatenate([[0], np.cumsum(same)])
        want, told = np.zeros(len(same), bool), np.zeros(len(same), bool)
        for s in np.flatnonzero(same):
            for e in np.flatnonzero(same) + 1:
                shared = total[e] - total[s] if e - s >= passages.LEAST else 0
                if shared and 100 * shared >= 75 * (2 * (e - s) - shared):
                    want[s:e] = True
        for s, e, t, f in passages.verified(x, y):
            assert e - s >= passages.LEAST <= f - t and passages._near(x.seq[s:e], y.seq[t:f])
            told[s:e] = True
        assert (told >= want).all()


def test_seeds_are_the_runs_of_equal_shingles():
    """Runs of SEED and more, each by its first looked-up place, also in texts that repeat phrases."""
    rng = np.random.default_rng(5)
    for k in (1, 2, 3, 7, 40):
        for _ in range(12):
            a, b = (np.concatenate([rng.integers(0, k, 60), np.arange(rng.integers(1, 90)) % k, rng.integers(0, k, 30)])
                    .astype(np.uint64) for _ in range(2))
            x, y = passages._Own(a), passages._Own(b, False)
            p, q, want = x.seq, y.seq, []
            for j in range(0, len(q), passages.SEED):
                for i in range(len(p)):
                    back, on = 0, 0
                    while back <= min(i, j) and back < passages.SEED + 1 and p[i - back] == q[j - back]:
                        back += 1
                    while i + on < len(p) and j + on < len(q) and p[i + on] == q[j + on]:
                        on += 1
                    if 0 < back <= passages.SEED <= back + on - 1:
                        want.append((i, j))
            assert list(passages._seeds(x, q)) == want


def test_repetitive_texts_take_linear_time():
    """One word or phrase 40,000 times, alone and behind a shared passage and other words."""
    import time
    own = lambda w, *x: passages._Own(passages.flat.mix(w.astype(np.uint64) + np.uint64(7)), *x)
    for period in (1, 30):
        junk = np.arange(40_000) % period
        start = time.perf_counter()
        assert passages.verified(own(junk), own(np.append(junk, 99), False)) == [(0, 39_996, 0, 39_996)]
        assert time.perf_counter() - start < 2
    head, rest = np.arange(1000, 1060), np.arange(2000, 2100)
    start = time.perf_counter()
    found = passages.verified(own(np.concatenate([head, rest, np.arange(10_000) % 2])),
                              own(np.concatenate([head, rest + 1000, np.arange(9_900) % 2, [99]]), False))
    assert found == [(160, 10_156, 160, 10_056), (0, 56, 0, 56)] and time.perf_counter() - start < 5


def test_places_outside_all_passages_are_not_searched():
    """Every stretch that passes lies in the bounds; texts without one take no growing."""
    rng = np.random.default_rng(17)
    for k in (3, 9, 40, 1 << 40):
        for _ in range(15):
            phrase = rng.integers(0, k, 70)
            a = np.concatenate([rng.integers(0, k, 60), phrase, np.full(int(rng.integers(0, 60)), 1), rng.integers(0, k, 30)])
            b = np.concatenate([rng.integers(0, k, 20), np.where(rng.random(70) < 0.03, 7, phrase), np.full(50, 1)])
            x, y = (passages._Own(passages.flat.mix(w.astype(np.uint64) + np.uint64(9))) for w in (a, b))
            few = max(1, int(passages._few_shared(x.few, y.few)))
            parts = passages._stretches(x, y, passages._inside(y.seq, x.set), few)
            inside = [p.inside for p in parts] if parts else [np.zeros(len(o.seq), bool) for o in (x, y)]
            for s in range(0, len(x.seq) - passages.LEAST + 1, 3):
                for t in range(0, len(y.seq) - passages.LEAST + 1, 3):
                    for n in (passages.LEAST, 60):
                        p, q = x.seq[s:s + n], y.seq[t:t + n]
                        if len(p) == n == len(q) and len(set(p.tolist()) & set(q.tolist())) and passages._near(p, q):
                            assert inside[0][s:s + n].all() and inside[1][t:t + n].all()


def test_stretches_of_few_other_shingles():
    rng = np.random.default_rng(1)
    for _ in range(60):
        n, most = int(rng.integers(46, 100)), int(rng.integers(0, 6))
        match = rng.random(n) < rng.random()
        seq = (rng.integers(0, int(rng.integers(2, 30)), n) + 100 * match).astype(np.uint64)
        want = np.zeros(n, bool)
        for s in range(n):
            for e in range(s + passages.LEAST, n + 1):
                if len(set(seq[s:e][~match[s:e]].tolist())) <= most:
                    want[s:e] = True
        assert (passages._few_others(seq, match, most) == want).all()


def test_known_places_are_not_found_again():
    """Of a pair that is linked already only what lies beyond is grown; two
    scattered runs of one frequent word beside unlike text are no seeds."""
    own = lambda w, *x: passages._Own(passages.flat.mix(w.astype(np.uint64) + np.uint64(7)), *x)
    rng = np.random.default_rng(3)
    p, q = rng.integers(100, 1 << 40, 80), rng.integers(100, 1 << 40, 90)
    a, b = (np.concatenate([p, rng.integers(100, 1 << 40, 50), q]) for _ in range(2))
    assert passages.verified(own(a), own(b, False)) == [(130, 216, 130, 216), (0, 76, 0, 76)]
    first, both = ([(0, 76)], [(0, 76)]), ([(0, 76), (130, 216)],) * 2
    assert passages.verified(own(a), own(b, False), first) == [(130, 216, 130, 216)]
    assert passages.verified(own(a), own(b, False), both) == []
    junk = np.concatenate([np.append(np.full(40, 5), rng.integers(6, 9, 20)) for _ in range(60)])
    other = np.concatenate([np.append(np.full(40, 5), rng.integers(10, 13, 20)) for _ in range(60)])
    x, y = own(junk), own(other, False)
    assert passages._stretches(x, y, passages._inside(y.seq, x.set), 1) is None and passages.verified(x, y) == []


def test_equal_texts_are_compared_once(spark, monkeypatch):
    """Copies get their whole text as a span and count as links, but only one meets other texts."""
    from tests.llm.cases import words
    seen = []
    links = passages.passage_links
    monkeypatch.setattr(passages, "passage_links", lambda docs: seen.append(docs.count()) or links(docs))
    one, near, short = words(90, 1), words(60, 2), words(30, 3)
    rows = [(k, " ".join(one)) for k in range(1, 9)] + [(1, " ".join(one)), (None, " ".join(one))]
    rows += [(20, " ".join(one[:70] + near)), (30, " ".join(short)), (31, " ".join(short)), (40, " ".join(near))]
    got = passages.near_passages(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    long = got[got["doc_id"].isna() | (got["doc_id"] < 9)]
    assert len(got) == len(rows) and len(long) == 10
    assert set(long["spans"]) == {"0:90"} and set(long["n_links"]) == {10} and set(long["class_id"]) == {1}
    rest = {r.doc_id: [r.spans, r.n_links, r.class_id] for r in got.itertuples()}
    assert rest[20] == ["0:130", 10, 1] and rest[40] == ["0:60", 10, 1] and rest[30] == ["", 0, 30] and rest[31] == ["", 0, 31]
    assert seen == [4]


def test_passages_beside_a_frequent_line(spark):
    """Two documents share a passage made up mostly of a line that many others
    have too: every key leads to the others, and still the two are found."""
    from tests.llm.cases import words
    line, tail = words(38, 900), words(14, 901)
    rows = [(k, " ".join(words(60, 1000 + k) + line + words(60, 2000 + k))) for k in range(300)]
    rows += [(k, " ".join(words(60, 1000 + k) + line + tail + words(60, 2000 + k))) for k in range(300, 310)]
    got = _by_id(passages.near_passages(spark.createDataFrame(rows, "doc_id long, text string"))).sort_index()
    near = got.loc[300:309]
    assert set(near["n_links"]) == {9} and set(near["class_id"]) == {300} and set(near["spans"]) == {"60:112"}
    far = got.loc[:299]
    assert set(far["spans"]) == {""}


def test_sets_of_a_large_group_are_sent_once(spark, monkeypatch):
    """However many slices a group is dealt in, each shingle of a window goes out
    once, and the same pairs are found as when the group comes whole."""
    import pyarrow as pa
    from tests.llm.cases import words
    rng = random.Random(5)
    line = words(10, 700)
    bodies = [words(70, 700 + k) for k in range(1, 13)]
    texts, part = [], []
    for k in range(90):
        body = list(bodies[k % 12]) if k < 60 else words(70, 900 + k)
        for x in rng.sample(range(70), k % 5):
            body[x] = f"w{k}x{x}"
        texts.append(" ".join(body[:35] + line + body[35:]))
        part.append(k % 7)
    seqs = [passages.flat.gram_hashes(passages._words(raw, np.array([0, len(raw)]))[0], passages.SHINGLE)
            for raw in (np.frombuffer(t.encode(), np.uint8) for t in texts)]
    shingle = next(x for x in seqs[0] if all(x in y for y in seqs[1:]))
    key = int((passages.flat.mix(np.array([shingle]) ^ passages._KEY[0]).view(np.int64)[0] & ~7))

    def dealt(slices):
        groups = [[{"key": key, "part": p, "slices": slices, "left": 40, "right": 40}] for p in part]
        batch = pa.RecordBatch.from_arrays([pa.array(range(90), pa.int64()), pa.array(texts), pa.array(groups)], names=["uid", "text", "groups"])
        return pa.Table.from_batches(passages._near_key([batch])).sort_by([("key", "ascending"), ("slice", "ascending")])

    def found(rows):
        table = pa.Table.from_batches(passages._search(rows.to_batches()))
        return table.to_pylist()

    whole, cut = dealt(1), dealt(9)
    size = lambda table: sum(len(x.as_py()) for x in table["shingles"])
    assert size(whole) == size(cut) and len(set(cut["slice"].to_pylist())) == 9
    want = {(r["uid"], r["other"]) for r in found(whole)}
    sets = [set((x >> np.uint64(32)).tolist()) for x in seqs]
    least = lambda a, b: int(passages._few_shared(whole["few"][a].as_py(), whole["few"][b].as_py()))
    assert want == {(a, b) for a in range(90) for b in range(a + 1, 90) if part[a] != part[b] and len(sets[a] & sets[b]) >= least(a, b)}
    kept = found(cut)
    assert size(cut) > sum(len(r["shingles"]) for r in kept) and all(r["other"] is None for r in kept)
    monkeypatch.setattr(passages, "PLACES", 400)
    rows = spark.createDataFrame([(r["key"], r["uid"], r["part"], r["few"], bytearray(r["shingles"])) for r in kept],
                                 "key long, uid long, part long, few int, shingles binary")
    assert {(r.a, r.b) for r in passages._searched_large(rows).distinct().collect()} == want


def test_a_text_goes_once_to_each_cell_of_pairs(spark):
    """All pairs of a family of texts are dealt, each once, while a cell gets a text once for all its pairs."""
    rows = [(k, "x" * 3000) for k in range(80)] + [(k, "y" * 60) for k in range(80, 90)]
    pairs = [(a, b, a % 2 == 0) for a in range(80) for b in range(a + 1, 80)] + [(80, b, False) for b in range(81, 90)]
    got = passages._cells(spark.createDataFrame(pairs, "a long, b long, linked boolean"),
                          spark.createDataFrame(rows, "uid long, text string")).collect()
    assert sorted((x.a, r.uid, x.linked) for r in got for x in r.pairs) == pairs
    cells = defaultdict(set)
    for r in got:
        assert r.uid not in cells[r.cell]
        cells[r.cell].add(r.uid)
    firsts = {(r.cell, r.uid) for r in got if r.first}
    assert {(r.cell, x.a) for r in got for x in r.pairs} == firsts
    assert len(cells) > 3 and len(got) < len(pairs) / 5
    assert all(sum(3000 if u < 80 else 60 for c, u in firsts if c == of) < 2 * passages.CELL_BYTES for of in cells)


def test_links_of_a_large_group_are_counted_whole(spark):
    from tests.llm.cases import words
    shared = words(70, 800)
    rows = [(k, " ".join(words(60, 3000 + k) + shared + words(60, 4000 + k))) for k in range(40)]
    got = _by_id(passages.near_passages(spark.createDataFrame(rows, "doc_id long, text string")))
    assert set(got["n_links"]) == {39} and set(got["spans"]) == {"60:130"} and set(got["class_id"]) == {0}


def test_half_disguised_personal_data():
    def more(text):
        found = pii.disguised(text, pii.detect(text))
        return [(k, text[a:b]) for k in pii.KINDS for a, b in found[k]]
    for mail in ("jane dot doe at example.com", "jane at mail.example dot com"):
        assert more(f"mail {mail}, please") == [("email", mail)]
    card = "4111 one111 1111 1111".replace("one111", "one 111")
    assert more(f"card {card} ok") == [("card", card)]
    assert more("call +1 five 5 five 123 4567 now") == [("phone", "+1 five 5 five 123 4567")]
    for clean in ("meet us at example.com today", "one 5 star hotel and 3 one way tickets", "a dot com firm at home",
                  "we met at 5 one evening", "look at the red dot at noon"):
        assert more(clean) == []


def test_token_files_round_trip(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = _by_id(token_files.token_files(small_docs(spark)))
    at = 0
    for doc_id in sorted(texts):
        ids = np.array([*tok.encode(texts[doc_id], add_special_tokens=False).ids, 0], "<u4")
        r = got.loc[doc_id]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_every_shard_is_read_by_a_task_of_its_own(spark, tmp_path):
    from pyspark.sql import functions as F
    docs = small_docs(spark)
    many = docs.union(docs.select((F.col("doc_id") + 100_000).alias("doc_id"), *docs.columns[1:])).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = token_files.write_tokens(many, str(tmp_path / "tokens"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    shards = manifest.count()
    assert shards >= 3
    read = token_files.read_documents(manifest, str(tmp_path / "tokens")).withColumn("task", F.spark_partition_id())
    assert read.select("task").distinct().count() >= shards - 1 and read.count() == many.count()


def test_rows_of_one_id_fill_several_shards(spark, tmp_path):
    from pyspark.sql import functions as F
    docs = small_docs(spark).withColumn("doc_id", F.lit(7).cast("long"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = token_files.write_tokens(docs, str(tmp_path / "tokens"))
        assert manifest.count() >= 3
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = token_files.read_documents(manifest, str(tmp_path / "tokens")).toPandas().sort_values("start")
    assert len(got) == docs.count() and (got["start"].to_numpy()[1:] == got["n_tokens"].cumsum().to_numpy()[:-1]).all()


def test_encoder_splits_as_the_tokenizer_does():
    import random
    rng = random.Random(1)
    own = token_files.Encoder("byte_bpe_50k.json")
    bits = ["a", " ", "\n", " ", "é", "1", "'s", "\t", "!", "\x1c", " ", " b", "<|endoftext|>"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 9))) for _ in range(3000)]
    ids, counts = own.encode(texts)
    want = [[*own.tokenizer.encode(t, add_special_tokens=False).ids, 0] for t in texts]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_sequences_are_read_without_copy(spark, tmp_path):
    manifest = token_files.write_tokens(small_docs(spark), str(tmp_path / "tokens")).toPandas()
    r = manifest.iloc[0]
    ids, mask = token_files.read_sequence(str(tmp_path / "tokens"), r["name"], 0)
    assert len(ids) == token_files.SEQUENCE and mask.to_pylist().count(True) == min(token_files.SEQUENCE, r["n_tokens"])
    last = -(-int(r["n_tokens"]) // token_files.SEQUENCE) - 1
    ids, mask = token_files.read_sequence(str(tmp_path / "tokens"), r["name"], last)
    assert sum(mask.to_pylist()) == r["n_tokens"] - last * token_files.SEQUENCE


def _plain_spans(t):
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(d):
        return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    found = lambda p, ok: [m.span() for m in re.finditer(p, t) if ok(m.group())]
    return {
        "email": found(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": found(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": found(r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": found(r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15)}


def test_plain_personal_data(spark, texts):
    import random
    rng = random.Random(2)
    bits = ["a", "@", ".", "1", "25", "-", " ", "+", "(", "x.y", "@b.c", "300.1", "4111 1111 1111 1111", "0", "٣"]
    for _ in range(4000):
        t = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert pii.detect(t) == _plain_spans(t), t
    got = _by_id(pii.personal_data(small_docs(spark)))
    for i, t in texts.items():
        want = _plain_spans(t)
        listed = ",".join(f"{k}:{a}:{b}" for k in pii.KINDS for a, b in want[k])
        assert got.loc[i, "base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [got.loc[i, f"n_{k}"] for k in pii.KINDS] == [len(want[k]) for k in pii.KINDS]


@pytest.mark.parametrize("text, kind, span", [
    ("write john (at) mail [dot] example dot com now", "email", "john (at) mail [dot] example dot com"),
    ("call +1 four one five five five five one two three four ok", "phone", "+1 four one five five five five one two three four"),
    ("see ｊoe＠exаmple.com here", "email", "ｊoe＠exаmple.com"),
    ("host one nine two.168.1.1 is up", "ip", "one nine two.168.1.1"),
])
def test_disguised_personal_data(text, kind, span):
    base = pii.detect(text)
    assert [text[a:b] for a, b in pii.disguised(text, base)[kind]] == [span]


def _lz(data):
    seen, out, at = set(), [], 0
    while at < len(data):
        j = at + 1
        while j <= len(data) and data[at:j] in seen:
            j += 1
        out.append(data[at:j])
        seen.add(data[at:j])
        at = min(j, len(data))
    return out


def test_fingerprint_buckets_have_a_task_each(spark):
    """Ranges of ids are dealt one to a task, none share one while others stand empty."""
    from pyspark.sql import functions as F

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = spark.range(40 * n).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    tasks = lz_fingerprint.compared_with_next(docs).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) == n and max(r["count"] for r in tasks) <= 80


def test_phrases(spark, texts):
    import random
    rng = random.Random(5)

    def hashes(data):
        return set(lz_fingerprint._hashes(data, np.cumsum([len(p) for p in _lz(data)]).tolist()).tolist())

    for _ in range(800):
        data = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 40)))
        cut = rng.randint(0, len(data))
        edited = data[:cut] + bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 30)))
        a, b = lz_fingerprint.both_phrase_hashes(data, cut, edited)
        assert set(a.tolist()) == hashes(data) and set(b.tolist()) == hashes(edited)
    got = _by_id(lz_fingerprint.compared_with_next(small_docs(spark)))
    order = sorted(texts, reverse=True)
    for i, after in zip(order, order[1:] + order[:1]):
        third = len(texts[i]) // 3
        edited = texts[i][:len(texts[i]) - third] + texts[after][:third]
        mine, theirs, new = lz_fingerprint.minima([lz_fingerprint.phrase_hashes(t.encode()) for t in (texts[i], texts[after], edited)])
        r = got.loc[i]
        assert r["n_chars"] == len(texts[i]) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["near_edited"] == (mine == new).mean() and r["near_next"] == (mine == theirs).mean()
        assert r["fingerprint"] == mine.astype(">u2").tobytes().hex()


def _targets(sizes):
    """Water filling, step by step."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, out, open_ = float(sum(sizes.values())), {}, set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not full:
            return out | {s: level * weight[s] for s in open_}
        for s in full:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def test_mix_meets_its_targets(spark):
    docs = small_docs(spark)
    got = mixing.mix(docs).toPandas()
    sizes = {i: len(spaced(t)) for i, t in docs.select("doc_id", "text").collect()}
    assert dict(zip(got["doc_id"], got["size"])) == sizes
    per = got.groupby("source").agg(size=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"), most=("size", "max"))
    want = _targets(per["size"].to_dict())
    assert all(abs(per.loc[s, "target"] - want[s]) < 1e-6 * want[s] for s in want)
    assert ((per["taken"] - per["target"]).abs() <= per["most"]).all() and (got["taken"] <= 3 * got["size"]).all()
    again = mixing.mix(docs.repartition(7)).toPandas()
    assert dict(zip(got["doc_id"], got["taken"])) == dict(zip(again["doc_id"], again["taken"]))


def test_mix_of_many_blocks_and_capped_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 50)
    monkeypatch.setattr(mixing, "FAN_IN", 3)
    rows = [(i, "w " * (1 + i * 7 % 40), ["a", "b", None, "c"][0 if i < 30 else 1 + i % 3]) for i in range(3000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).toPandas()
    per = got.fillna({"source": "~"}).groupby("source").agg(size=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"))
    want = _targets({(None if s == "~" else s): n for s, n in per["size"].items()})
    assert per.loc["a", "target"] == 3 * per.loc["a", "size"] == per.loc["a", "taken"]
    for s in per.index:
        assert abs(per.loc[s, "target"] - want[None if s == "~" else s]) < 1e-6 * per.loc[s, "target"]
        assert abs(per.loc[s, "taken"] - per.loc[s, "target"]) <= 60


def test_repeated_rows_of_the_mix(spark):
    docs = small_docs(spark)
    got = Counter(r[0] for r in mixing.repeated(docs).select("doc_id").collect())
    taken = mixing.mix(docs).toPandas()
    assert got == {i: c for i, c, t in zip(taken["doc_id"], taken["copies"], taken["taken"]) if t}


def test_oracles_have_a_query():
    assert set(queries.oracle_sql()) <= set(queries.queries())


@pytest.mark.parametrize("text, kind, span", [
    ("schreib jane ät mail punkt de bitte", "email", "jane ät mail punkt de"),
    ("escribe a jane (arroba) mail (punto) es hoy", "email", "jane (arroba) mail (punto) es"),
    ("écris à marie arobase exemple point fr", "email", "marie arobase exemple point fr"),
    ("ruf +49 eins fünf fünf eins zwei drei vier fünf sechs an", "phone", "+49 eins fünf fünf eins zwei drei vier fünf sechs"),
    ("llama +34 seis uno dos tres cuatro cinco seis siete ocho", "phone", "+34 seis uno dos tres cuatro cinco seis siete ocho"),
    ("see \U0001D423\U0001D41A\U0001D427\U0001D41E@\U0001D426\U0001D41A\U0001D422\U0001D425.\U0001D41C\U0001D428\U0001D426", "email",
     "\U0001D423\U0001D41A\U0001D427\U0001D41E@\U0001D426\U0001D41A\U0001D422\U0001D425.\U0001D41C\U0001D428\U0001D426"),
])
def test_disguises_of_four_languages(text, kind, span):
    base = pii.detect(text)
    assert [text[a:b] for a, b in pii.disguised(text, base)[kind]] == [span]


@pytest.mark.parametrize("text", ["meet me at foo dot com", "look at the point where it is", "ce point est important", "der punkt ist klar",
                                  "un deux trois", "10² m² at 5", "hola arroba", "uno dos tres amigos"])
def test_clean_sentences(text):
    assert not any(pii.disguised(text, pii.detect(text)).values())


@pytest.mark.parametrize("unit", [" ", "(", "( ", "one ", "1 one ", "a at ", "a dot ", "(at)a", "@", "a.", "+1(", "dot  ", "ａ"])
def test_hostile_texts_take_linear_time(unit):
    import time
    text = "dot " + unit * (500_000 // len(unit))
    began = time.process_time()
    pii.disguised(text, pii.detect(text))
    assert time.process_time() - began < 10  # some tenths of a second; a quadratic step takes minutes


@pytest.mark.parametrize("shared", [60, 300, 390, 700])
def test_hot_anchors_are_cut_by_place_not_into_windows(spark, monkeypatch, shared):
    """A passage in many different texts: few rows are made, no repeat is lost."""
    monkeypatch.setattr(run_index, "HOT", 3)
    made = []

    def counted(df, name):
        out = store.stored(df, name)
        made.append((name, out.count()))
        return out

    monkeypatch.setattr(run_index, "stored", counted)
    rng = random.Random(shared)
    passage = "".join(rng.choices("abcdefgh", k=shared))
    tails = ["".join(rng.choices("abcdefgh", k=500)) for _ in range(3)]
    texts = ["".join(rng.choices("abcdefgh", k=600)) + passage + "".join(rng.choices("abcdefgh", k=40)) + tails[i % 3] for i in range(30)]
    texts += [texts[0][:900], "x" + texts[1][300:]]
    got = _by_id(run_index.without_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    places = Counter(t[i:i + 400] for t in texts for i in range(len(t) - 399))
    for i, t in enumerate(texts):
        gone = {b for a in range(len(t) - 399) if places[t[a:a + 400]] > 1 for b in range(a, a + 400)}
        assert bytes(got.loc[i, "kept"]).decode() == "".join(x for b, x in enumerate(t) if b not in gone)
    halves = [n for name, n in made if name == "context-halves"]
    contexts = next(n for name, n in made if name == "contexts")
    assert halves and max(halves) <= 2 * contexts < 2000
