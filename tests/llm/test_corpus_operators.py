"""Operators that compare rows: chat, near-duplicates, repeated passages, leaks, packing, scores."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from reviewloom.llm import brown_lm, chat_format, decontaminate, near_dedup, packing
from reviewloom.llm.graph import stars
from reviewloom.llm.queries import VOCABULARY
from reviewloom.llm.substring_dedup import substring_dedup

rng = random.Random(7)
VOC = [f"w{k}" for k in range(400)]


def prose(n):
    return [rng.choice(VOC) for _ in range(n)]


def edited(words, share):
    return [rng.choice(VOC) if rng.random() < share else w for w in words]


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS n", "2 AS bucket", "'k' AS kept", "3 AS _id", "4 AS n_words")


def test_chat_by_comparing_beginnings(spark):
    chats = {
        1: ["a", "b"], 2: ["a", "b", "c"], 3: ["a", "b", "c"], 4: ["a", "x"], 5: ["a"],
        6: [None, "b"], 7: ["", "b"], 8: ["b", "a"], None: ["n", "m"],
    }
    rows = [(c, t, "user" if t % 2 else None, x) for c, turns in chats.items()
            for t, x in enumerate(turns)] + [(2, 1, "user", "b"), (9, 0, None, "q"),
                                             (9, 0, None, "p")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat_format.chat_format(df.selectExpr("*", "1 AS _pos")).collect()}
    assert set(got) == {2, 4, 6, 7, 8, 9, None}
    assert got[2].n_turns == 3
    assert got[9].rendered == ("<|im_start|>user\np<|im_end|>\n<|im_start|>user\nq<|im_end|>\n")
    assert got[6].rendered == got[7].rendered
    assert chat_format.chat_format(df.limit(0)).count() == 0


def test_chat_snapshots_of_every_length(spark):
    texts = [rng.choice("ab") for _ in range(60)]
    rows = [(c, t, "user", texts[t]) for c in range(60) for t in range(c + 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert [r.conv_id for r in chat_format.chat_format(df).collect()] == [59]


def test_stars_of_chains_and_hubs(spark):
    links = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 130)] + [(200, 201)]
    rng.shuffle(links)
    df = spark.createDataFrame([(a, b) if rng.random() < .5 else (b, a) for a, b in links],
                               "a long, b long")
    got = {r.b: r.a for r in stars(df).collect()}
    assert got == {**{k: 0 for k in range(1, 31)}, **{k: 100 for k in range(101, 130)}, 201: 200}
    assert stars(df.limit(0)).count() == 0


def components(texts, size, percent=80):
    sets = [near_dedup.shingles(t, size) for _, t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * len(sets[i] | sets[j]) and sets[j]:
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(texts):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return [least.get(root(i)) if s else texts[i][0] for i, s in enumerate(sets)]


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_by_brute_force(spark, size):
    texts = []
    for g, share in enumerate([0.02, 0.05, 0.08, 0.1]):
        base = prose(60 + 40 * g)
        texts += [(None, " ".join(edited(base, share))) for _ in range(14)]
    texts = [(len(texts) - k, t) for k, (_, t) in enumerate(texts)]
    texts += [(200 + k, " ".join(prose(30))) for k in range(10)]
    texts += [(300, None), (301, ""), (302, " \n"), (303, "one"), (304, "ONE"), (305, "one two"),
              (306, "One  two"), (307, "a " * 30_000), (308, "a a a a a a"), (1, "same id"),
              (None, texts[0][1]), (None, "null alone"), (309, texts[5][1]), (309, texts[5][1])]
    rows = near_dedup.near_duplicates(docs_of(spark, texts), size=size).collect()
    want = Counter(zip((d for d, _ in texts), components(texts, size),
                       (len(near_dedup.shingles(t, size)) for _, t in texts), strict=True))
    assert Counter((r.doc_id, r.component_id, r.n_shingles) for r in rows) == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_without_copies_keeps_columns(spark):
    text = " ".join(prose(50))
    df = docs_of(spark, [(3, text), (2, text + " more"), (9, "other"), (None, None)])
    out = near_dedup.without_copies(df)
    assert out.columns == df.columns
    assert {r.doc_id for r in out.collect()} == {2, 9, None}
    assert near_dedup.without_copies(df.limit(0)).count() == 0


def test_blocks_of_a_large_group_meet(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    sigs = np.arange(10)[:, None].repeat(200, 1).astype("<u2")
    sigs[7] = sigs[5] = sigs[2]
    texts = [f"a b c {k}" for k in range(10)]
    texts[7] = texts[5] = texts[2]
    rows = [(1, k, k, bytearray(sigs[k].tobytes()), texts[k]) for k in range(10)]
    rows.append((2, 1, 5, bytearray(sigs[1].tobytes()), texts[1]))
    df = spark.createDataFrame(rows, "centre long, n long, comp long, sig binary, text string")
    got = {tuple(r) for r in near_dedup._block_links(df, 200, 2, 80, 1e-6).collect()}
    assert got <= {(2, 7), (2, 5), (5, 7)} and len(got) >= 2


def test_posterior_bounds():
    assert near_dedup.least_matches(0.8, 1e-6, 200) < 0.8 * 200
    random_ = np.random.default_rng(1)
    misses = sum(
        near_dedup.surviving((random_.random((500, 200)) < 0.8).astype("<u2"),
                             np.ones((500, 200), "<u2"), near_dedup.checkpoints(200, 0.8, 1e-6)
                             ).min() < 0 for _ in range(10))
    assert misses == 0
    low = near_dedup.surviving((random_.random((500, 200)) < 0.4).astype("<u2"),
                               np.ones((500, 200), "<u2"), near_dedup.checkpoints(200, 0.8, 1e-6))
    assert (low < 0).all()


def kept_words(texts, window=13):
    least = {}
    split = [(t or "").encode().split() for _, t in texts]
    ids = [math.inf if d is None else d for d, _ in texts]
    for d, w in zip(ids, split, strict=True):
        for i in range(len(w) - window + 1):
            g = tuple(w[i:i + window])
            least[g] = min(least.get(g, math.inf), d)
    out = []
    for d, w in zip(ids, split, strict=True):
        gone = {j for i in range(len(w) - window + 1) if least[tuple(w[i:i + window])] < d
                for j in range(i, i + window)}
        out.append((len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    return out


def test_substrings_by_brute_force(spark):
    passages = [prose(n) for n in (13, 14, 40, 200)]
    texts = [(k, " ".join(prose(rng.randrange(30)) + rng.choice(passages)[rng.randrange(3):]
                          + prose(rng.randrange(20)))) for k in range(60)]
    texts += [(100, None), (101, ""), (102, "x " * 30_000), (103, "x " * 40), (None, texts[3][1]),
              (None, texts[3][1]), (5, texts[8][1]), (5, texts[5][1]), (104, texts[2][1] + "\x85é\n\tz"),
              (-7, texts[9][1])]
    df = docs_of(spark, texts)
    out = substring_dedup(df)
    assert out.columns == [c for c in df.columns if c != "n_words"] + [
        "n_words", "n_removed", "kept_text"]
    got = Counter((r.doc_id, r.text, r.n_words, r.n_removed, r.kept_text) for r in out.collect())
    assert got == Counter((d, t, *k) for (d, t), k in zip(texts, kept_words(texts), strict=True))
    assert substring_dedup(df.limit(0)).count() == 0


def test_windows_under_one_hash_are_told_apart(monkeypatch):
    from reviewloom.llm import substring_dedup as module
    monkeypatch.setattr(module, "MIX", np.uint64(0))  # the hash is that of the last word
    ids = np.array([1, 2, 9, 3, 2, 9, 1, 2, 9, 3, 2, 9])
    got = module._repeats(ids, np.array([0, 3, 6, 9]), np.array([5, 1, 4, 2]), 3)
    assert got.tolist() == [True, False, False, True]


def naive_coverage(doc, item, least):
    used, covered, total = [False] * len(doc), [False] * len(item), 0
    while True:
        best = (1 - least, 0, 0)
        for a in range(len(doc)):
            for c in range(len(item)):
                k = 0
                while (a + k < len(doc) and c + k < len(item) and doc[a + k] == item[c + k]
                       and not used[a + k] and not covered[c + k]):
                    k += 1
                best = min(best, (-k, a, c))
        best = (-best[0], *best[1:])
        if best[0] < least:
            return total
        for j in range(best[0]):
            used[best[1] + j] = covered[best[2] + j] = True
        total += best[0]


def test_tiles_cover_as_much_as_marking_the_longest_each_time():
    for _ in range(300):
        item = [rng.randrange(6) for _ in range(rng.randrange(3, 25))]
        doc = [rng.randrange(6) for _ in range(rng.randrange(50))]
        tiles = decontaminate.greedy_tiles(doc, item, 3)
        places = [(d + j, i + j) for d, i, k in tiles for j in range(k)]
        assert all(doc[d] == item[i] for d, i in places)
        assert len({d for d, _ in places}) == len({i for _, i in places}) == len(places)
        assert len(places) == naive_coverage(doc, item, 3)


def test_leaks(spark):
    items = [prose(40), prose(20), ["short", "one"]]
    whole = " ".join(items[0])
    shuffled = " ".join(items[0][30:] + items[0][:12] + prose(5) + items[0][12:30])
    rows = [(1, f"intro {whole} end"), (2, whole.upper().replace(" ", ", ")), (3, shuffled),
            (4, " ".join(prose(300))), (5, " ".join(items[0][:12])), (6, None), (7, ""),
            (8, "short one"), (8, whole), (None, " ".join(items[1])), (9, whole + " x" * 100_000)]
    bench = spark.createDataFrame(
        [(k, " ".join(w)) for k, w in enumerate(items)] + [(None, None), (7, ""), (0, whole)],
        "item_id long, text string").selectExpr("*", "1 AS n_tiles")
    for size in (decontaminate.BLOCK_BYTES, 50):
        got = decontaminate.contaminated_pairs(docs_of(spark, rows), bench, block_bytes=size)
        found = got.collect()
        assert {(r.doc_id, r.item_id) for r in found} == {
            (1, 0), (2, 0), (3, 0), (8, 0), (None, 1), (9, 0)}
        assert all(r.coverage == 1.0 and r.contaminated for r in found)
    clean = decontaminate.clean_documents(docs_of(spark, rows), bench)
    assert sorted(r.doc_id for r in clean.collect()) == [4, 5, 6, 7, 8]
    assert decontaminate.contaminated_pairs(docs_of(spark, rows), bench.limit(0)).count() == 0
    assert decontaminate.contaminated_pairs(docs_of(spark, []), bench).count() == 0


def optimum(sizes, capacity):
    """Bins of the best packing, by trying all."""
    best = len(sizes)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(sizes):
            best = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + sizes[k] <= capacity:
                place(k + 1, [*bins[:i], bins[i] + sizes[k], *bins[i + 1:]])
        place(k + 1, [*bins, sizes[k]])

    place(0, [])
    return best


def test_bounds_never_pass_the_optimum():
    for _ in range(150):
        sizes = np.array([rng.randrange(1, 31) for _ in range(rng.randrange(1, 8))])
        bins, offsets = packing.best_fit_decreasing(sizes, 30)
        best = optimum(sorted(sizes.tolist(), reverse=True), 30)
        assert packing.lower_bound(sizes, 30) <= best <= bins.max() + 1
        for b in set(bins.tolist()):
            used = sorted((o, s) for o, s, x in zip(offsets, sizes, bins, strict=True) if x == b)
            assert [o for o, _ in used] == np.cumsum([0] + [s for _, s in used])[:-1].tolist()
            assert sum(s for _, s in used) <= 30


def test_groups_with_gaps_exchange_pieces(spark):
    sizes = [rng.choice([26, 27, 41, 42, 51, 12]) for _ in range(600)]
    df = spark.createDataFrame([(k, s, "x") for k, s in enumerate(sizes)],
                               "id long, length long, _row string")
    apart = packing.pack(df, capacity=100, group=30, rounds=0)
    mended = packing.pack(df, capacity=100, group=30, rounds=3)
    one, other = (x.select("sequence_id").distinct().count() for x in (apart, mended))
    assert packing.packing_bound(df, capacity=100) <= other <= one
    placed = defaultdict(list)
    for r in mended.collect():
        assert r._row == "x"
        placed[r.sequence_id].append((r.offset, r.length))
    assert sum(map(len, placed.values())) == 600
    for parts in placed.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0] + [n for _, n in parts])[:-1].tolist()
        assert sum(n for _, n in parts) <= 100


def test_pieces_and_sequences_round_trip(spark):
    rows = [(1, None), (2, ""), (3, "hello world " * 3000), (3, "hello"), (None, "a b c"), (4, "x")]
    pieces = packing.token_pieces(docs_of(spark, rows), VOCABULARY)
    placed = packing.pack(pieces)
    got = defaultdict(list)
    for r in placed.collect():
        assert len(r.ids) == 4 * r.length <= 4 * 4096 and r.start == 4096 * r.piece
        got[r.doc_id].append((r.piece, bytes(r.ids)))
    assert [len(got[k]) for k in (1, 2, 3, 4, None)] == [1, 1, 3, 1, 1]
    assert got[1][0][1] == (1).to_bytes(4, "little")
    flat = {r.sequence_id: bytes(r.ids) for r in packing.sequences(placed).collect()}
    for r in placed.collect():
        assert flat[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)] == bytes(r.ids)
    assert packing.pack(packing.token_pieces(docs_of(spark, []), VOCABULARY)).count() == 0


def test_class_scores(spark):
    texts = [(k, " ".join(edited(VOC[:40] if k % 2 else VOC[200:240], 0.1) * 2))
             for k in range(120)]
    texts += [(500, None), (501, ""), (502, "never seen"), (None, "Null ID"), (1, texts[1][1])]
    rows = brown_lm.class_scores(docs_of(spark, texts), classes=6, clustered=100, listed=150).collect()
    counts, ends = Counter(), 0
    for d, t in texts:
        if d is None or zlib.crc32(str(d).encode()) % 10:
            counts.update((t or "").lower().split())
            ends += 1
    total, types = sum(counts.values()) + ends, len(counts) + 1
    by_id = defaultdict(list)
    for d, t in texts:
        by_id[d].append((t or "").lower().split())
    assert len(rows) == len(texts)
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
        assert any(
            r.base_score == pytest.approx(
                sum(math.log10((c + 0.1) / (total + 0.1 * (types + 1)))
                    for c in [*(counts[x] for x in w), ends]), abs=1e-6)
            and (r.n_tokens, r.n_known) == (len(w) + 1, sum(counts[x] > 0 for x in w) + 1)
            for w in by_id[r.doc_id])
        assert r.train_tokens == total
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert brown_lm.class_scores(docs_of(spark, [])).count() == 0


def test_class_model_is_a_distribution(spark):
    """Over all words, the unseen ones of each group, and the end, probabilities add up to 1."""
    listed = [(f"v{k}", 5 + k) for k in range(30)]
    units = brown_lm.Units(listed, 10)
    size = units.end + 1
    cls = np.arange(size) % 4
    cls[-1] = 4
    types = np.zeros(size)
    types[:10] = 1
    types[-1] = 1
    tokens = np.zeros(size)
    for w, n in listed:
        u = units.of([w.encode()])[1][0]
        tokens[u] += n
        types[u] += u >= 10
    tokens[-1] = 7
    pairs = np.arange(25.0).reshape(5, 5)
    model = brown_lm.Model(units, cls, tokens, types, pairs, 7)
    assert (10 ** model.step).sum(axis=1) == pytest.approx(np.ones(5))
    inside = np.zeros(5)
    for i, (w, n) in enumerate(listed):
        c = cls[units.of([w.encode()])[1][0]]
        inside[c] += (n + 0.1) / 10 ** model.room[c]
    for g in range(brown_lm.GROUPS):
        c = cls[10 + g]
        inside[c] += 0.1 / 10 ** model.room[c]
    assert inside[:4] == pytest.approx(np.ones(4))


def test_exchange_finds_planted_classes():
    random_ = np.random.default_rng(3)
    true = np.repeat([0, 1, 2], 20)
    table = np.zeros((61, 61))
    seq = [60]
    state = 0
    for _ in range(20_000):
        state = (state + 1) % 3
        seq.append(int(random_.choice(np.flatnonzero(true == state))))
    np.add.at(table, (seq[:-1], seq[1:]), 1)
    cls = brown_lm.exchange(table, 3, 12)
    assert all(len(set(cls[:60][true == t])) == 1 for t in range(3))
    assert len(set(cls[:60])) == 3 and cls[60] == 3


def test_pipeline(spark, tmp_path):
    base = prose(80)
    leak = prose(30)
    rows = [(1, " ".join(base)), (2, " ".join(base) + " tail"), (3, " ".join(prose(60))),
            (4, " ".join(prose(40) + leak)), (5, "too short"), (6, None),
            (7, " ".join(prose(50)) + " token=abcdefghijklmnop " + " ".join(prose(30)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'en' AS lang", "'s' AS source", "CAST(length(text) AS BIGINT) AS n_chars")
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(0, " ".join(leak))], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    spark.createDataFrame([(k, 1, 0) for k in (1, 2, 3, 4, 7)],
                          "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    left = [{1, 2, 3, 4, 7}, {1, 3, 4, 7}, {1, 3, 7}, {1, 3, 7}]
    state = docs
    for (_, stage), want in zip(corpus_pipeline.STAGES, left, strict=False):
        out = stage(spark, state, folder)
        assert out.columns == docs.columns
        assert {r.doc_id for r in out.collect()} == want
        state = out
    text = {r.doc_id: r for r in state.collect()}[7]
    assert "[secret]" in text.text and text.n_chars == len(text.text)
    out = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in out} == {1, 3, 7} and len({r.sequence_id for r in out}) == 1


def test_words_are_numbered_by_line():
    from reviewloom.llm.substring_dedup import numbered_words

    words, lengths = numbered_words("a é\na\né b\xa0 aa a\n".encode())
    assert lengths.tolist() == [2, 1, 4]
    assert words.tolist() == [0, 1, 0, 1, 2, 3, 0]
