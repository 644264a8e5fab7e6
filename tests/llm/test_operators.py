"""Each operator against a brute-force version or its library, with nulls, empty and repeated rows, ties, empty tables and clashing columns."""
import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinmatch.llm import _links, bpe_automaton, components, decontamination, parity_join, quality_rules, sharding, site_quality, substring_dedup, token_output, token_rollup, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, node long, keys string, spans string"


def docs(spark, rows):
    """Documents with further columns, some named as operators name theirs."""
    return spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}" if (i or 0) % 4 else None, len(t or ""), 1.0, 5, "k", "s") for i, t in rows], SCHEMA)


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return [f"w{x}" for x in rng.integers(0, 3000, n)]


def edited(words, at):
    return [("x%d" % a if i in at else w) for a, (i, w) in enumerate(enumerate(words))]


@pytest.fixture(scope="module")
def corpus():
    base, other = prose(1, 200), prose(2, 120)
    rows = [(i, " ".join(edited(base, {3 * i, 7 * i + 1}))) for i in range(1, 12)]
    rows += [(20, " ".join(other)), (21, " ".join(other)), (21, " ".join(other)), (22, " ".join(other).upper().lower()), (23, " ".join(other[:-1]))]
    rows += [(30, None), (31, ""), (32, " \t\n"), (33, "one two"), (34, "One  two"), (35, "one two three"), (None, " ".join(other)), (None, None), (36, "a b c d e f g h"), (37, "a b c d e f g h i")]
    rows += [(40 + k, " ".join(prose(50 + k, 60))) for k in range(8)] + [(60, " ".join(prose(60, 9000)))]
    return rows


def brute_classes(rows):
    sets = {}
    for i, t in rows:
        w = [x for x in (t or "").lower().split() if x]
        own = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
        sets.setdefault(i, []).append(own)
    ids = [i for i in sets if i is not None]
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}, sets


def test_parity_join(spark, corpus):
    got = parity_join.similarity_classes(docs(spark, corpus).repartition(5)).collect()
    expected, sets = brute_classes(corpus)
    assert len(got) == len(corpus)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == expected
    assert sorted(r.n_shingles for r in got) == sorted(len(s) for own in sets.values() for s in own)
    assert sorted((r.n_shingles, r.component_id) for r in got if r.doc_id is None) == [(0, None), (116, 20)]
    assert parity_join.similarity_classes(docs(spark, [])).count() == 0


def linked_pair(rng, n):
    """Two sets of about n hashes and whether their Jaccard index is 4/5 or more."""
    pool = np.unique(rng.integers(0, 1 << 63, 2 * n + 8, dtype=np.uint64) * np.uint64(2))
    rng.shuffle(pool)
    a = pool[:n]
    keep = a[int(rng.integers(0, n // 4 + 1)) :]
    b = np.concatenate([keep, pool[n : n + int(rng.integers(0, n // 4 + 1))]])
    return np.sort(a), np.sort(b), 100 * len(keep) >= 80 * (len(a) + len(b) - len(keep))


SIZES = [4, 5, 6, 7, 8, 9, 15, 16, 17, 31, 33, 60, 64, 100, 127, 130, 500]


def test_keys_lose_no_link():
    """Whatever the order of tokens, the joined ones of linked sets have one in common."""
    rng = np.random.default_rng(5)
    for n in SIZES:
        for _ in range(40):
            *pair, linked = linked_pair(rng, n)
            order = np.uint64(rng.integers(1 << 62))
            keys = []
            for s in pair:
                keys.append(set())
                for _code, tokens, spare in parity_join.tokens_of(s):
                    tokens = np.unique(tokens)
                    keys[-1].update(tokens[np.argsort(tokens * (order * np.uint64(2) + np.uint64(1)))][: len(tokens) - spare].tolist())
            assert not linked or keys[0] & keys[1]


def test_sketches_lose_no_link():
    rng = np.random.default_rng(6)
    pruned = 0
    for n in SIZES:
        for _ in range(40):
            a, b, linked = linked_pair(rng, n)
            assert not linked or _links.may_link(len(a), _links.sketch(a), len(b), _links.sketch(b))
            other = np.sort(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            pruned += not _links.may_link(len(a), _links.sketch(a), n, _links.sketch(other))
    assert pruned > 0.99 * 40 * len(SIZES)


def test_parity_join_hot_buckets(spark, monkeypatch):
    """500 near copies in several classes that share half of their words, in tiles, with and without frequent tokens and sketches."""
    rng = np.random.default_rng(8)
    common, bases = prose(700, 60), [prose(710 + k, 50) for k in range(10)]
    rows = [(i, " ".join(common + edited(bases[i % 10], {int(rng.integers(50))}) + prose(800 + i, int(rng.integers(3))))) for i in range(500)]
    frame = docs(spark, rows).repartition(3)
    run = lambda: {r.doc_id: r.component_id for r in parity_join.similarity_classes(frame).collect()}
    expected, _ = brute_classes(rows)
    assert run() == expected
    monkeypatch.setattr(_links, "TILE", 64)
    monkeypatch.setattr(parity_join, "FREQUENT", 2)
    assert run() == expected
    monkeypatch.setattr(_links, "may_link", lambda *a: True)
    assert run() == expected


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, 3), (3, 9), (9, 9), (None, 4), (700, 5)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long").repartition(6)).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {3: 3, 5: 3, 9: 3, 700: 3}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_end_in_one_task_when_few_edges_are_left(spark, monkeypatch):
    """Few edges cost two tables, not several a round; larger ones go on in rounds until few are left. Same classes."""
    edges = [(k, k + 1) for k in range(100, 160)] + [(k, k // 2) for k in range(1002, 1040)] + [(7, 7), (None, 3), (9, 8), (9, 8), (-5, 2**62), (2**62, 4)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(6)
    made = []
    monkeypatch.setattr(components, "written", lambda d, name, f=components.written: made.append(name) or f(d, name))
    found = []
    for most in (components.LAST_EDGES, 20, 0):
        monkeypatch.setattr(components, "LAST_EDGES", most)
        made.clear()
        found.append(sorted(map(tuple, components.components(df).collect())))
        assert (len(made) == 2) == (most > 100)
    assert found[0] == found[1] == found[2]
    of = dict(found[0])
    assert len(of) == len(found[0]) and 3 not in of and 7 not in of
    assert [of[k] for k in (100, 160, 9, 8, -5, 2**62, 4)] == [100, 100, 8, 8, -5, -5, -5]


def test_substring_dedup(spark):
    shared, close = prose(7, 60), prose(8, 70)
    line = lambda k: " ".join(prose(100 + k, 40))
    rows = [(3, line(1) + "\n" + " ".join(shared)), (2, " ".join(shared) + "\nshort line\n" + line(2)), (1, " ".join(close)), (5, line(3) + "\n" + " ".join(edited(close, {20})))]
    rows += [(7, "short line\nshort line"), (8, None), (9, ""), (None, " ".join(shared)), (2, " ".join(shared) + "\nshort line\n" + line(2))]
    frame = docs(spark, rows).repartition(4)
    places = {(r.doc_id, r.line): r for r in substring_dedup.repeated_paragraphs(frame).collect()}
    assert {k for k, r in places.items() if r.removed} == {(3, 1), (5, 1)}
    assert places[(3, 1)].first_doc == 2 and places[(5, 1)].first_doc == 1
    after = {(r.doc_id, r.text) for r in substring_dedup.deduplicate(frame).collect()}
    assert (3, line(1)) in after and (5, line(3)) in after and (7, "short line\nshort line") in after and (None, " ".join(shared)) in after and (8, None) in after
    assert substring_dedup.deduplicate(docs(spark, [])).count() == 0
    bands, rows_ = substring_dedup.tuned()
    assert bands * rows_ <= substring_dedup.MOST_HASHES and (1 - 0.8**rows_) ** bands <= 1e-4


def test_substring_dedup_runs(spark, monkeypatch):
    run, other = prose(400, 52), prose(401, 300)
    within = lambda k, words, a=70: prose(k, a) + words + prose(k + 1, 130 - a)
    wrapped = lambda words, n: "\n".join(" ".join(words[i : i + n]) for i in range(0, len(words), n))
    rows = [(1, " ".join(within(410, run))), (2, " ".join(within(420, run, 20))), (3, wrapped(within(430, run, 33), 12)), (4, " ".join(within(440, run[:49])))]
    # 5 and 6 share words with each other that the first holder of their anchors need not have
    rows += [(5, " ".join(within(450, run[10:] + other[:30]))), (6, " ".join(within(460, run[10:] + other[:30]))), (7, " ".join(["w"] * 200)), (8, None), (None, " ".join(within(410, run)))]
    after = {r.doc_id: r.text for r in substring_dedup.deduplicate(docs(spark, rows).repartition(4)).collect()}
    assert {i: after[i] for i in (1, 4, 5, 8, None)} == {i: t for i, t in rows if i in (1, 4, 5, 8, None)}
    assert after[2].split() == within(420, [], 20) and after[3].split() == within(430, [], 33)
    assert after[6].split() == within(460, []) and after[7].split() == ["w"] * 50

    left = spark.createDataFrame([(i, 0, t) for i, t in rows], "doc_id long, row long, text string")
    seen, want = set(), set()
    for i, t in sorted((r for r in rows if r[0] and r[1])):
        w = t.split()
        at = {}
        for k in range(len(w) - 49):
            key = tuple(w[k : k + 50])
            if key in seen or (key in at and k >= at[key] + 50):
                want.add((i, k))
            at.setdefault(key, k)
        seen |= set(at)
    words = lambda spans: {(i, k) for i, a, b in spans for k in range(a, b)}
    for size in (substring_dedup.STRETCH, 1):  # what repeats is settled in one stretch, or across
        monkeypatch.setattr(substring_dedup, "STRETCH", size)
        got = {r.doc_id: r for r in substring_dedup.repeated_runs(left).collect()}
        assert words((i, a, b) for i, r in got.items() for a, b in zip(r.begins, r.ends, strict=True)) == words((i, k, k + 50) for i, k in want)
        assert {i for i, r in got.items() if r.holds} == {1, 5, 7}


def test_substring_dedup_short_lines(spark):
    wrap = lambda words: "\n".join(" ".join(words[i : i + 12]) for i in range(0, len(words), 12))
    passage, line = prose(500, 60), " ".join(prose(501, 40))
    rows = [(1, "head of it\n\n" + wrap(passage) + "\n\nend of it"), (2, line + "\n" + wrap(edited(passage, {30})) + "\n\n" + " ".join(prose(502, 20))), (3, "a few words\n\na few words")]
    frame = docs(spark, rows)
    places = {(r.doc_id, r.line, r.lines): r.removed for r in substring_dedup.repeated_paragraphs(frame).collect()}
    assert places == {(1, 2, 5): False, (2, 0, 1): False, (2, 1, 5): True}  # one word differs: no run of 50
    after = {r.doc_id: r.text for r in substring_dedup.deduplicate(frame).collect()}
    assert after == {1: rows[0][1], 2: line + "\n\n" + " ".join(prose(502, 20)), 3: rows[2][1]}


def test_substring_dedup_rows(spark, tmp_path):
    shared, own, late = (" ".join(prose(600 + k, 40)) for k in range(3))
    rows = [(1, shared), (2, own + "\n" + shared), (2, late + "\n" + " ".join(prose(603, 35))), (2, shared + "\n" + late), (None, shared), (None, shared)]
    after = [(r.doc_id, r.text) for r in substring_dedup.deduplicate(docs(spark, rows)).collect()]
    kept = [t for i, t in after if i == 2]
    assert own in kept and sum(shared in t for i, t in after) == 3 and sum(t.count(late) for t in kept) == 1 and sum(" ".join(prose(603, 35)) in t for t in kept) == 1
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [(r.doc_id, r.n_paragraphs, r.n_shared, r.n_removed) for r in substring_dedup.query(spark, str(tmp_path)).collect()]
    assert len(got) == len(rows)
    assert [x for x in got if x[0] is None] == [(None, 1, 1, 0)] * 2 and (1, 1, 1, 0) in got and {places.n_places for places in substring_dedup.repeated_paragraphs(docs(spark, rows)).where("doc_id = 1").collect()} == {5}


def test_substring_dedup_against_all_pairs(spark):
    """Lines near and less near to each other: classes, first places and removals as brute force over all pairs has them."""
    rng = np.random.default_rng(12)
    bases, rows, lines = [prose(3000 + k, int(rng.integers(30, 90))) for k in range(20)], [], {}
    for d in range(160):
        own = []
        for _ in range(int(rng.integers(1, 4))):
            words = list(bases[int(rng.integers(len(bases)))])
            for at in rng.integers(0, len(words), int(rng.integers(0, 5))):
                words[at] = f"x{rng.integers(10**6)}"
            own.append(words[: len(words) - int(rng.integers(0, 4))] if len(words) > 40 else words)
        rows.append((d, "\n".join(map(" ".join, own))))
        lines |= {(d, k): w for k, w in enumerate(own) if len(w) >= 30}
    sets = {p: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for p, w in lines.items()}
    parent = {p: p for p in lines}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    links = 0
    for p in lines:
        for q in lines:
            if p < q and 100 * len(sets[p] & sets[q]) >= 80 * len(sets[p] | sets[q]):
                links += 1
                a, b = sorted((find(p), find(q)))
                parent[b] = a
    assert links > 200
    got = {(r.doc_id, r.line): (r.first_doc, r.first_line, r.removed) for r in substring_dedup.repeated_paragraphs(docs(spark, rows).repartition(4)).collect()}
    assert got == {p: (*find(p), find(p) != p) for p in lines}


def test_paragraph_words():
    assert [(i, n, len(w)) for i, n, w, _ in substring_dedup.paragraph_words(b"a\x0bb\x0cc\rd e\n\nf", 5)] == [(0, 1, 5)]
    blank = substring_dedup.paragraph_words(b"a b\nc d\n \t\ne f g h", 4)
    assert [(i, n, t) for i, n, _, t in blank] == [(0, 2, b"a b\nc d"), (3, 1, b"e f g h")]
    assert substring_dedup.paragraph_words(None, 1) == substring_dedup.paragraph_words(b"", 1) == []


def test_decontamination(spark):
    long, short = prose(9, 25), ["rare", "short", "item"]
    bench = spark.createDataFrame([(1, " ".join(long), 0), (2, "Rare-short item", 0), (2, None, 0), (3, "", 0), (None, "lonely words", 0)], "item_id long, text string, n_words int")
    rows = [(1, "x " + " ".join(long[3:14]) + " y"), (2, " ".join(long[:9])), (3, "a RARE, short: item. rare short item"), (4, None), (5, ""), (6, "lonely words"), (7, " ".join(long) * 1), (7, " ".join(long) + " " + " ".join(long))]

    def brute(t):
        words = decontamination.split_words((t or "").encode())
        hit, items = set(), set()
        for name, item in (("1", long), ("2", short), (None, ["lonely", "words"])):
            item = [w.encode() for w in item]
            wins = [item[k : k + 10] for k in range(max(1, len(item) - 9))]
            for w in wins:
                for at in range(len(words) - len(w) + 1):
                    if words[at : at + len(w)] == w:
                        hit |= set(range(at, at + len(w)))
                        items |= {name} - {None}
        return len(words), len(hit), sorted(items)

    for size in (1 << 20, 12):  # one block; several blocks, an item in pieces
        got = decontamination.decontaminate(docs(spark, rows), bench, block_words=size).collect()
        assert sorted((r.doc_id, r.n_words, sum(b - a for a, b in r.spans), r.item_ids) for r in got) == sorted((i, *brute(t)) for i, t in rows)
    assert decontamination.decontaminate(docs(spark, []), bench).count() == 0
    assert [r.spans for r in decontamination.decontaminate(docs(spark, rows[:1]), bench.limit(0)).collect()] == [[]]
    kept = decontamination.decontaminate(docs(spark, rows), bench, keep_rows=True).select("doc.*")
    assert kept.columns == docs(spark, []).columns


def test_decontamination_index_memory():
    """A million words of items take less than 200 MB while the index is made, and some tens of bytes a word after."""
    import tracemalloc

    rng = np.random.default_rng(3)
    words = [f"v{k}".encode() for k in range(50_000)]
    items = [(str(k), [words[i] for i in rng.integers(0, len(words), 500)]) for k in range(600)] + [("0", words[:9])]
    tracemalloc.start()
    index = decontamination.Index(items, 10)
    index.order(np.arange(len(index.vocabulary))[::-1].copy())
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 60 << 20 and len(index.start) == 600 * 491 + 1
    ids = np.array([index.vocabulary.index(w) for w in items[5][1][20:40]] + [-2], np.int64)
    assert sorted(index.occurrences(ids)[0].tolist()) == list(range(11))


TEXTS = ["", None, "Hello world, don't stop", "é ñ ü ß 日本 😀 x́", "<|endoftext|>a<|endoftext|>", "  lead\n\n trail  ", "aaaaaaaaaaaa hahahaha", "12³½ a_b--c", "İx Σς", "1234567890 " * 30, "\x1c\x1d y"]


def tokenizer(name):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    return public_tokenizers.path(name), Tokenizer.from_file(public_tokenizers.path(name))


def test_bpe_automaton(spark):
    path, lib = tokenizer("byte_bpe_50k.json")
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[3])]
    got = bpe_automaton.round_trip(docs(spark, rows), path).collect()
    own = lambda t: lib.encode(t or "", add_special_tokens=False).ids
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = [(i, len(own(t)), sha(",".join(map(str, own(t)))), sha(lib.decode(own(t), skip_special_tokens=False))) for i, t in rows]
    assert sorted(map(tuple, got)) == sorted(expected)
    ids = bpe_automaton.encode(docs(spark, rows), path)
    assert {r.doc_id: r.ids for r in ids.collect()} == {i: own(t) for i, t in rows}
    assert {r.doc_id: r.text for r in bpe_automaton.decode(ids, path).collect()} == {i: t or "" for i, t in rows}
    assert bpe_automaton.round_trip(docs(spark, []), path).count() == 0


def test_automaton_on_random_words():
    path, lib = tokenizer("byte_bpe_50k.json")
    encoder = bpe_automaton.Encoder(bpe_automaton.Automaton(bpe_automaton._spec(path)))
    rng = np.random.default_rng(11)
    letters = list("aeihtnsr oudl'LRE.,!  \n\tx0123é日😀_-=")
    for _ in range(1500):
        t = "".join(rng.choice(letters, rng.integers(0, 30)))
        assert encoder.encode(t) == lib.encode(t, add_special_tokens=False).ids, repr(t)


def test_sequences():
    rng = np.random.default_rng(2)
    for n, u in ((0, 1), (1, 1), (1, 10**9), (1000, 1001), (3000, 5_000_000), (700, 100)):
        v = np.sort(rng.integers(0, u, n)).astype(np.int64)
        packed = token_output.pack_sequence(v, u)
        s = token_output.Sequence(packed)
        assert s.end == len(packed) and s.values().astype(np.int64).tolist() == v.tolist()
        assert [s.select(i) for i in range(0, n, max(1, n // 37))] == v[:: max(1, n // 37)].tolist()
        if n >= 700 and u > n:
            assert 8 * len(packed) < n * (3 + np.log2(u / n)) + 2500


def test_token_output(spark, tmp_path):
    path, lib = tokenizer("word_bpe_49k.json")
    rows = [(i * 7 - 20, t) for i, t in enumerate(TEXTS)] + [(1, "same id, b"), (1, "same id, a"), (None, "no id")]
    for size in (1 << 20, 10):
        folder = f"file://{tmp_path}/ids{size}"
        token_output.write_ids(docs(spark, rows).repartition(3), folder, path, block_ids=size)
        got = sorted(map(tuple, token_output.read_ids(spark, folder, with_ids=True).collect()), key=lambda r: r[1])
        order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
        start, expected = 0, []
        for i, t in order:
            ids = lib.encode(t or "", add_special_tokens=False).ids + [1]
            expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
            start += len(ids)
        assert got == expected
    token_output.write_ids(docs(spark, []), f"file://{tmp_path}/none", path)
    assert token_output.read_ids(spark, f"file://{tmp_path}/none").count() == 0


def test_block_select():
    ids = np.arange(20, dtype="<u2")
    data = token_output.pack_block(0, 0, 5, [None, -5, -5, 90], np.array([3, 0, 10, 7]), ids.tobytes(), 2) + b"\n"
    for block in (token_output.Block(data), [*token_output.blocks_of(data + data)][1]):
        assert block.doc_ids(0, 4) == [None, -5, -5, 90] and block.doc_ids(2, 4) == [-5, 90] and block.doc_ids(0, 1) == [None]
        assert [block.document(i).tolist() for i in range(4)] == [[0, 1, 2], [], list(range(3, 13)), list(range(13, 20))]
        assert block.ends(0, 4).tolist() == [0, 3, 3, 13, 20] and block.ends(2, 3).tolist() == [3, 13] and block.before == 5
    with pytest.raises(ValueError):
        token_output.Block(data[:-2])


def test_sequence_of_many_sparse_values():
    """Low bits are packed a stretch at a time: 300,000 values below 2^60 take a few MB, not hundreds."""
    import tracemalloc

    v = np.sort(np.random.default_rng(1).integers(0, 1 << 60, 300_000)).astype(np.uint64)
    tracemalloc.start()
    s = token_output.Sequence(token_output.pack_sequence(v, 1 << 60))
    assert tracemalloc.get_traced_memory()[1] < 32 << 20
    tracemalloc.stop()
    assert (s.values() == v).all() and (s.selected(70_001, 70_100) == v[70_001:70_100]).all()


def test_sharding(spark):
    rows = [(i, f"text {i}" if i % 5 else None) for i in range(101)] + [(None, "x"), (7, "again"), (7, "again")]
    got = sharding.interleave(docs(spark, rows).repartition(4)).collect()
    assert len(got) == len(rows)
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for k in range(8):
        assert sorted(r.slot for r in got if r.shard == k) == list(range(sizes[k]))
    for s in {r.source for r in got}:
        each = [sum(r.source == s and r.shard == k for r in got) for k in range(8)]
        assert max(each) - min(each) <= 2
    sums = {(r.doc_id, r["size"], r.text_crc32) for r in got}
    assert all((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) in sums for i, t in rows)
    again = sharding.interleave(docs(spark, rows).repartition(2)).collect()
    assert sorted((r.doc_id or -1, r.text_crc32, r.shard, r.slot) for r in got if r.doc_id != 7) == sorted((r.doc_id or -1, r.text_crc32, r.shard, r.slot) for r in again if r.doc_id != 7)
    assert sharding.interleave(docs(spark, [])).count() == 0
    assert sorted(r.shard for r in sharding.interleave(docs(spark, [(1, "a"), (2, "b")])).collect()) != [0, 0]


def brute_rules(t):
    words = [w for w in (t or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    wins = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if wins[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (t or "").split("\n") if x.split()]
    return len(words), sum(map(len, words)), sum(ch in "#*$%&|<>" for ch in t or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_rules(spark):
    good = [(i, " ".join(prose(i, 80))) for i in range(20)]
    bad = [(100 + i, " ".join(f"{w}###" for w in prose(i + 300, 80))) for i in range(5)]
    odd = [(200, "a b c a b c"), (201, "a a a a a"), (202, "x y\nx y\n\n \nx y"), (203, None), (204, ""), (205, "a b c d a b c | <é>"), (None, "a b"), (201, "a a a a a"), (206, "a b"), (207, "q " * 3000)]
    rows = good + bad + odd
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(None, 1, 1)], "doc_id long, quality int, toxic int")
    got = quality_rules.quality_rules(docs(spark, rows), labels).collect()
    assert sorted((r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == sorted((i or -1, *brute_rules(t)) for i, t in rows)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].kept for i, _ in good) and not any(by_id[i].kept for i, _ in bad + odd)
    assert by_id[200].base_failed and by_id[207].base_failed and not by_id[100].base_failed
    assert quality_rules.quality_rules(docs(spark, []), labels.limit(0)).count() == 0
    assert all(r.llr_score == 0.0 for r in quality_rules.quality_rules(docs(spark, rows), labels.limit(0)).collect())


def test_quality_rules_shuffles_texts_of_trusted_rows_only(spark, monkeypatch):
    """The same plan whatever the labels' size: a broadcast of bits, then a join by ids of what passes them."""
    rows = docs(spark, [(i, f"w{i} a") for i in range(2000)] + [(None, "x"), (7, "again")])
    ids = spark.range(0, 2000, 7).withColumnRenamed("id", "doc_id")
    for bits in (quality_rules.FILTER_WORDS, 1):
        monkeypatch.setattr(quality_rules, "FILTER_WORDS", bits)
        got = quality_rules.among(rows, ids)
        assert sorted(r.doc_id for r in got.collect()) == sorted([*range(0, 2000, 7), 7])
        plan = got._jdf.queryExecution().sparkPlan().toString()
        assert plan.index("SortMergeJoin") < plan.index("BroadcastHashJoin")  # the filter stands below the join
    assert quality_rules.among(rows, ids.select(ids.doc_id.cast("int"))).count() == 287
    plan = quality_rules.log_ratio(rows, ids)._jdf.queryExecution().sparkPlan().toString()
    assert "getbit" in plan


def test_quality_rules_trusts_all_labels(spark):
    labels = spark.range(200_050).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    last = [r.doc_id for r in labels.orderBy(F.xxhash64("doc_id").desc()).limit(4).collect()]
    rows = [(i, " ".join(prose(i, 80))) for i in last] + [(300_000 + i, " ".join(prose(i + 900, 80))) for i in range(4)]
    got = {r.doc_id: r.llr_score for r in quality_rules.quality_rules(docs(spark, rows), labels).collect()}
    assert min(got[i] for i in last) > max(got[300_000 + i] for i in range(4))


def test_quality_scores_against_counts(spark):
    """llr_score and kept by plain Python: hashed unigrams and bigrams, add-one smoothing, mean log ratio."""
    import xxhash

    def chain(*parts):
        h = 42
        for p in parts:
            h = xxhash.xxh64_intdigest(p if isinstance(p, bytes) else int(p).to_bytes(4, "little"), seed=h)
        return h

    signed = lambda h: h - (1 << 64) if h >> 63 else h
    buckets = quality_rules.BUCKETS

    def bins(t):
        w = [x.encode() for x in (t or "").split()]
        return [signed(chain(x)) % buckets for x in w] + [signed(chain(*([w[i - 1]] if i else []), 1, x)) % buckets for i, x in enumerate(w)]

    rows = [(i, " ".join(prose(i, 60 + i))) for i in range(30)] + [(40, None), (41, ""), (42, "one"), (None, "w1 w2 w3"), (3, "again " * 70), (43, " ".join(prose(77, 40_000)))]
    trusted = {*range(0, 30, 3), 42}
    labels = spark.createDataFrame([(i, 1) for i in trusted] + [(1, 0), (2, None), (None, 1)], "doc_id long, quality int")
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for i, t in rows:
        np.add.at(raw, bins(t), 1)
        if i in trusted:
            np.add.at(target, bins(t), 1)
    llr = np.log((target + 1) / (target.sum() + buckets)) - np.log((raw + 1) / (raw.sum() + buckets))
    want = sorted((i or -1, round(float(llr[bins(t)].mean()) if bins(t) else 0.0, 9)) for i, t in rows)
    got = quality_rules.quality_rules(docs(spark, rows), labels).collect()
    assert sorted((r.doc_id or -1, round(r.llr_score, 9)) for r in got) == want
    assert all(r.kept == (not r.base_failed and r.llr_score >= quality_rules.THRESHOLD) for r in got) and any(r.kept for r in got)


def test_interleaving_order(spark):
    """pos by plain Python: seeded shuffle inside each source, then fractional ranks, ties by the source's hash."""
    rows = [(i, f"t{i}") for i in range(120)] + [(None, "x")]
    frame = docs(spark, rows)
    hashed = frame.select("doc_id", "source", F.xxhash64(F.lit(sharding.SEED), "doc_id").alias("h"), F.xxhash64(F.lit(sharding.SEED), F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))).alias("t")).collect()
    ranked = []
    for s in {r.source for r in hashed}:
        own = sorted((r.h, r.doc_id if r.doc_id is not None else -1, r.t) for r in hashed if r.source == s)
        ranked += [((2 * k + 1) / (2 * len(own)), t, d) for k, (_, d, t) in enumerate(own)]
    want = [d for *_, d in sorted(ranked)]
    got = sharding.interleave(frame.repartition(5)).orderBy("pos").collect()
    assert [r.doc_id if r.doc_id is not None else -1 for r in got] == want and [r.pos for r in got] == list(range(len(rows)))


def test_rollup(spark, tmp_path):
    schema = "kind string, source string, lang string, tokenizer string, n_tokens long, old_tokens long, docs long"
    change = lambda *rows: spark.createDataFrame([(*r, 9) for r in rows], schema)
    rollup = token_rollup.Rollup(spark, f"file://{tmp_path}/r")
    assert rollup.totals().count() == 0
    assert rollup.commit("a", change(("insert", "s", "en", "v", 10, None), ("insert", "s", "en", "v", 5, None), ("insert", None, "en", "v", None, None)))
    assert not rollup.commit("a", change(("insert", "s", "en", "v", 99, None)))
    assert rollup.commit("b", change(("revise", "s", "en", "v", 7, 5), ("delete", "s", "en", "v", 10, None)))
    assert rollup.commit("c", spark.createDataFrame([], schema))
    assert sorted(map(str, map(tuple, rollup.totals().collect()))) == sorted(map(str, [("s", "en", "v", 1, 7), (None, "en", "v", 1, 0)]))
    assert rollup.commit("d", change(("delete", "s", "en", "v", 7, None))) and rollup.totals().count() == 1
    assert rollup.batches() == ["a", "b", "c", "d"]
    lost = tmp_path / "r" / "batch=e"
    lost.mkdir()
    assert rollup.batches() == ["a", "b", "c", "d"] and rollup.commit("e", change(("insert", "t", "en", "v", 1, None)))
    with pytest.raises(ValueError):
        rollup.commit("../x", spark.createDataFrame([], schema))


def test_rollup_maintained_totals(spark, tmp_path):
    """Totals after every commit against the sum of all changes; folded or not; each batch once, whoever else writes it."""
    schema = "kind string, source string, lang string, tokenizer string, n_tokens long, old_tokens long"
    rng, sums = np.random.default_rng(2), Counter()
    rollup = token_rollup.Rollup(spark, f"file://{tmp_path}/r", fold_every=2)
    for k in range(5):
        rows = [(str(rng.choice(["insert", "delete", "revise"])), str(rng.choice(["a", "b"])), "en", "v", int(rng.integers(50)), int(rng.integers(50))) for _ in range(6)]
        for kind, source, *_, n, old in rows:
            sums[source, "docs"] += {"insert": 1, "delete": -1, "revise": 0}[kind]
            sums[source, "tokens"] += {"insert": n, "delete": -n, "revise": n - old}[kind]
        assert rollup.commit(f"b{k}", spark.createDataFrame(rows, schema)) and not rollup.commit(f"b{k}", spark.createDataFrame(rows, schema))
        got = {r.source: (r.docs, r.tokens) for r in rollup.totals().collect()}
        assert got == {s: v for s in "ab" if (v := (sums[s, "docs"], sums[s, "tokens"])) != (0, 0)}
    assert rollup._maintained()[0] == 2 and rollup._pending(rollup._maintained()) == ["b4"]
    # A writer that came second finds the name taken.
    late = token_rollup.deltas(spark.createDataFrame([("insert", "a", "en", "v", 9, None)], schema))
    assert not rollup._put(late, rollup._batch("b1")) and {r.source: (r.docs, r.tokens) for r in rollup.totals().collect()} == got
    for kind in ("upsert", None):
        with pytest.raises(Exception, match="unknown kind of change"):
            rollup.commit("bad", spark.createDataFrame([(kind, "a", "en", "v", 9, None)], schema))
    assert "bad" not in rollup.batches() and rollup.fold() and not rollup.fold() and {r.source: (r.docs, r.tokens) for r in rollup.totals().collect()} == got


def test_toxicity(spark):
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(1200):
        words, toxic = prose(1000 + i, 60), rng.random() < 0.2
        if toxic:
            words[int(rng.integers(60))] = "vile" + str(rng.choice(["ness", "ly", "st"]))
        rows.append((i, " ".join(words)))
        if rng.random() < 0.6:
            labels.append((i, int(toxic), None))
    truth = {i: int("vile" in t) for i, t in rows}
    rows += [(5000, None), (5001, ""), (None, "vileness all over"), (3, rows[3][1])]
    frame = docs(spark, rows)
    table = spark.createDataFrame(labels + [(None, 1, None)], "doc_id long, toxic int, quality int")
    data = frame.select("doc_id", "text")
    got = toxicity.score(data, toxicity.train(data, table)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    right = [r.predicted == truth[r.doc_id] for r in got if r.doc_id in truth]
    assert np.mean(right) > 0.97
    held = {r[0] for r in frame.where(toxicity.held_out(F.col("doc_id"))).select("doc_id").collect()}
    assert held == {i for i, _ in rows if i is not None and zlib.crc32(str(i).encode()) % 3 == 1}
    none = toxicity.train(data, table.where("toxic = 9"))
    assert none is None and {r.score for r in toxicity.score(data.limit(5), none).collect()} == {0.0}
    assert toxicity.score(data.limit(0), None).count() == 0


def test_toxicity_curve():
    """A rising curve of the ratio of densities, also where few margins differ."""
    at = lambda c, z: [float(np.interp(x, *c)) for x in z]
    two = toxicity.curve(np.full(25, 2.0), np.concatenate([np.full(75, -1.0), np.full(25, 2.0)]), 0.25)
    assert at(two, [-1.0, 2.0, 5.0]) == [0.0, 1.0, 1.0]
    three = toxicity.curve(np.repeat([0.0, 1.0, 2.0], [10, 10, 80]), np.repeat([0.0, 1.0, 2.0], [600, 200, 200]), 0.2)
    assert np.allclose(at(three, [0.0, 1.0, 2.0]), [0.2 * 0.1 / 0.6, 0.2 * 0.1 / 0.2, 0.2 * 0.8 / 0.2])
    falling = toxicity.curve(np.repeat([0.0, 1.0], [60, 40]), np.repeat([0.0, 1.0], [50, 50]), 0.1)
    assert np.allclose(at(falling, [0.0, 1.0]), [0.1, 0.1])  # pooled
    one = toxicity.curve(np.zeros(3), np.zeros(9), 0.3)
    assert at(one, [-4.0, 0.0]) == [pytest.approx(0.3)] * 2
    rng = np.random.default_rng(3)
    many = toxicity.curve(rng.normal(1, 1, 500), rng.normal(0, 1, 2000), 0.2)
    assert (np.diff(many[1]) >= 0).all() and (np.diff(many[0]) >= 0).all() and many[1].min() >= 0 and many[1].max() <= 1


def test_toxicity_risk():
    """The risk and its gradient against their definition, a margin at a time."""
    rng = np.random.default_rng(9)
    loss = lambda z: np.log1p(np.exp(-z))
    signs = set()
    for prior in (0.1, 0.5, 0.9):
        for shift in (-2.0, 0.0, 2.0):
            zp, zu = rng.normal(shift, 1, 40), rng.normal(-shift, 1, 90)
            kept = prior * np.mean([loss(z) for z in zp])
            held = np.mean([loss(-z) for z in zu]) - prior * np.mean([loss(-z) for z in zp])
            assert np.allclose(toxicity.risk(zp, zu, prior), (kept, held))
            of = (lambda p, u: sum(toxicity.risk(p, u, prior))) if held >= 0 else (lambda p, u: -toxicity.risk(p, u, prior)[1])
            signs.add(held >= 0)
            for k, part in enumerate(toxicity.gradient(zp, zu, prior)):
                for i in (0, 7):
                    step = np.zeros(len(part))
                    step[i] = 1e-5
                    up, down = (of(zp + s * step, zu) if k == 0 else of(zp, zu + s * step) for s in (1, -1))
                    assert np.isclose(part[i], (up - down) / 2e-5, atol=1e-7)
    assert signs == {True, False}


def test_site_quality(spark):
    rows = [(i, " ".join(prose(i, 90))) for i in range(60)] + [(100 + i, "### buy ### now ###") for i in range(30)] + [(300, None), (301, ""), (None, "a b"), (5, "twice")]
    labels = spark.createDataFrame([(i, int(i < 100), 0) for i, _ in rows[:90:2]] + [(None, 1, 0), (300, None, 0)], "doc_id long, quality int, toxic int")
    got = site_quality.site_quality(docs(spark, rows), labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and 0 < r.path_share < 1 for r in got)
    assert all(r.kept == (r.doc_id < 100) for r in got if r.doc_id is not None and r.doc_id < 200 and r.doc_id != 5)
    assert site_quality.site_quality(docs(spark, []), labels.limit(0)).count() == 0
    assert all(r.evidence == 0 for r in site_quality.site_quality(docs(spark, rows), labels.limit(0)).collect())


def test_sites_of_urls(spark):
    urls = {"https://Example.org/blog/a?x=/b": ("example.org", "blog"), "http://u:p@h.net:8080": ("h.net", None), "http://h.net/#a": ("h.net", None), "ftp://[2001:db8::1]:21/x": ("[2001:db8::1]", "x"), "no url": (None, None), "": (None, None), None: (None, None)}
    got = spark.createDataFrame([(u,) for u in urls], "url string").select("url", *site_quality.site_of(F.col("url"))).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == urls
    frame = docs(spark, [(i, " ".join(prose(i, 60))) for i in range(4)]).withColumn("url", F.concat(F.lit("http://h"), F.col("doc_id") % 2, F.lit(".org/p/q")))
    host, path = site_quality.site_of(F.col("url"))
    got = site_quality.site_quality(frame.withColumns({"host": host, "path": path}), spark.createDataFrame([], "doc_id long, quality int"), host="host", path="path").collect()
    assert {(r.host, r.path) for r in got} == {("=h0.org", "=p"), ("=h1.org", "=p")}


def test_site_quality_against_formulas(spark):
    """The hierarchy of shares by plain Python, from each document's own chance: hosts are shrunk to the whole, paths to their host, each without the document itself."""
    rows = [(i, " ".join(prose(i, 60 + i)) + (" ### buy" * (i % 5 == 0))) for i in range(80)]
    labels = spark.createDataFrame([(i, int(i % 5 != 0), 0) for i in range(0, 80, 2)], "doc_id long, quality int, toxic int")
    frame = docs(spark, rows).withColumn("lang", F.when(F.col("doc_id") % 7 < 3, "de").otherwise("en"))
    got = site_quality.site_quality(frame, labels).collect()
    groups: dict = {}
    for r in got:
        for key in ((), (r.host,), (r.host, r.path)):
            g = groups.setdefault(key, [0.0, 0])
            g[0], g[1] = g[0] + r.chance, g[1] + 1

    def strength(level, share_of):
        own = [(g, share_of(k)) for k, g in groups.items() if len(k) == level]
        n, q = sum(g[1] for g, _ in own), sum(g[1] ** 2 for g, _ in own)
        spread = sum(g[1] * (g[0] / g[1] - s) ** 2 for g, s in own) - sum(s * (1 - s) for _, s in own)
        m = sum(g[0] for g, _ in own) / n
        between = max(0.0, spread / (n - q / n))
        return min(max(m * (1 - m) / between - 1 if between > 0 else 1e4, 1.0), 1e4)

    base = 0.8
    share = (groups[()][0] + base) / (groups[()][1] + 1)
    by_host, by_path = strength(1, lambda k: share), strength(2, lambda k: groups[k[:1]][0] / groups[k[:1]][1])
    for r in got:
        (hg, hn), (pg, pn) = groups[r.host,], groups[r.host, r.path]
        host = (by_host * share + hg - r.chance) / (by_host + hn - 1)
        path = min(max((by_path * host + pg - r.chance) / (by_path + pn - 1), 1e-6), 1 - 1e-6)
        assert r.host_share == pytest.approx(host) and r.path_share == pytest.approx(path)
        assert r.score == pytest.approx(1 / (1 + np.exp(-(r.evidence + np.log(path / (1 - path)))))) and r.kept == (r.score >= site_quality.THRESHOLD)


def test_rollup_null_labels(spark, tmp_path):
    spark.createDataFrame([(1, "a-b c", "s", "en"), (2, "a-b c", "s", "en"), (3, "a-b c", "s", "en")], "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0, None), (2, None, None), (3, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.tokenizer: (r.docs, r.tokens) for r in token_rollup.query(spark, str(tmp_path)).collect()}
    assert got == {"words-1": (2, 3 + 2), "runs-2": (2, 3 + 3)}
