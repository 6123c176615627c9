"""The training-data operators against brute force, on small tables with every odd case."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from lakesieve.llm import bpe, elias_fano, embedding_dedup, exact_dedup, jaccard, langid, mixing, shingles, substring_dedup, token_files, toxicity, warc
from lakesieve.llm.graph import components

ODD = [None, "", " ", "a", "A b c", "a b c", "a  b   c ", "\x1c \x1c a", "é ß 日本語 テスト", "x" * 3000, "<|endoftext|> hi", "don't  we'll", "\n\n \t"]


def docs(spark, texts, ids=None, extra=True):
    rows = [(i, t, "z", 7) for i, t in zip(ids or range(len(texts)), texts, strict=True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, name string, id int")
    return df if extra else df.select("doc_id", "text")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")


def low(t):
    return (t or "").encode().lower()


# 5


def test_fingerprints_combine():
    data = random.Random(1).randbytes(10_000)
    whole = exact_dedup.fingerprint(data)
    assert whole == exact_dedup.fingerprint(data, chunk=64)
    a, b = data[:3333], data[3333:]
    assert whole == exact_dedup.combine(exact_dedup.fingerprint(a), exact_dedup.fingerprint(b), len(b))


@pytest.mark.parametrize(("modulus", "chunk"), [(exact_dedup.MODULUS, 1 << 20), (3, 2)])
def test_exact_groups(spark, modulus, chunk):
    """A modulus of 3 makes most texts of a length collide: comparing the chunks must tell them apart."""
    texts = [*ODD, "A B C", "ab", "cd", "AB", "ef", "ab"]
    ids = [*range(len(texts) - 1), None]
    got = exact_dedup.exact_groups(docs(spark, texts, ids), modulus=modulus, chunk=chunk).collect()
    groups = {}
    for i, t in zip(ids, texts, strict=True):
        groups.setdefault(low(t), []).append(i)
    want = Counter((i, max((x for x in g if x is not None), default=None), len(g), i == max((x for x in g if x is not None), default=None), hashlib.sha256(t).hexdigest()) for t, g in groups.items() for i in g)
    assert Counter((r.id, r.keep_id, r.group_size, r.kept, r.sha256) for r in got) == want


def test_exact_groups_repeated_rows_and_empty(spark):
    got = exact_dedup.exact_groups(docs(spark, ["a", "a", "a"], [1, 1, 0])).collect()
    assert sorted((r.id, r.group_size, r.kept) for r in got) == [(0, 3, False), (1, 3, False), (1, 3, True)]
    assert exact_dedup.exact_groups(empty(spark)).count() == 0


# 10


def test_mix_meets_targets(spark):
    rnd = random.Random(3)
    rows = [(i, " ".join("w" * rnd.randrange(1, 60)) if i % 50 else None, rnd.choice(["a", "b", "b", "b", "b", "c", None])) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.pareto_mix(df).collect()
    size = Counter()
    for _, t, s in rows:
        size[s] += len((t or "").split())
    total, names = sum(size.values()), sorted(s for s in size if s) + [None]
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, free, left = {}, set(names), float(total)
    while True:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * size[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        for s in over:
            target[s] = 3.0 * size[s]
        left -= sum(target[s] for s in over)
        free -= over
    taken = Counter()
    for r in got:
        assert r.source_size == size[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert r.taken in (r.size * r.copies,) and r.copies <= 3
        taken[r.source] += r.taken
    assert len(got) == len(rows)
    for s in names:
        assert abs(taken[s] - target[s]) <= 60
    again = {(r.id, r.taken) for r in mixing.pareto_mix(df.repartition(7)).collect()}
    assert again == {(r.id, r.taken) for r in got}
    assert mixing.pareto_mix(empty(spark)).count() == 0


def test_mix_runs_no_python(spark):
    plan = mixing.pareto_mix(spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# 6 and 8


@pytest.fixture(scope="module")
def public():
    return pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def strings():
    rnd = random.Random(0)
    return [t or "" for t in ODD] + ["".join(rnd.choice(" \n\tab'sé1,. \x1c") for _ in range(rnd.randrange(60))) for _ in range(800)]


def test_bpe_is_tiktokens(public, strings):
    import tiktoken

    path = public.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    want = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    enc = bpe.TextEncoder(path, public.PATTERN, limit=60)  # so small that it is emptied again and again
    for k in range(0, len(strings), 40):
        part = strings[k : k + 40]
        for t, ids in zip(part, enc.encode(part), strict=True):
            assert ids.tolist() == want.encode_ordinary(t)
            assert enc.bpe.decode(ids.tolist()) == t.encode()


@pytest.mark.parametrize("seed", range(12))
def test_bpe_neighbours_by_undoing_merges(public, seed):
    """Neighbours fit where merging their bytes by rank gives them back: a trained vocabulary, made-up ones, and some whose merges don't rise in rank."""
    rnd = random.Random(seed)
    if seed < 2:
        ranks = bpe.load_ranks(public.path("byte_bpe_multi_50k.tiktoken"))
    else:
        tokens = {bytes([c]) for c in b"ab"} if seed % 2 else {bytes([c]) for c in b"abc"}
        order = sorted(tokens)
        while len(order) < 60:
            t = rnd.choice(order) + rnd.choice(order)
            if t not in tokens and len(t) < 12:
                tokens.add(t)
                order.append(t)
        if seed > 7:
            rnd.shuffle(order)
        ranks = {t: k for k, t in enumerate(order)}
    b = bpe.PrefixBPE(ranks)
    sound = [t for t in rnd.sample(sorted(ranks.values()), min(len(ranks), 4000)) if b.alone(t)]
    assert all(b.merged(b.bytes_of[t]) == [t] for t in sound)
    assert not any(b.merged(b.bytes_of[t]) == [t] for t in set(rnd.sample(sorted(ranks.values()), 50)) if not b.alone(t))
    pairs = [(rnd.choice(sound), rnd.choice(sound)) for _ in range(6000)] if seed < 2 else [(x, y) for x in sound for y in sound]
    want = [b.merged(b.bytes_of[x] + b.bytes_of[y]) == [x, y] for x, y in pairs]
    assert True in want and False in want
    assert [b.fits(x, y) for x, y in pairs] == want


def test_bpe_work_on_new_words(public):
    """New words merge no bytes anew for each pair of neighbours, and try no lengths that no token has there."""
    import tiktoken

    class Counting(dict):
        asked = 0

        def get(self, *a):
            self.asked += 1
            return super().get(*a)

    ranks = bpe.load_ranks(public.path("byte_bpe_multi_50k.tiktoken"))
    want = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(5)
    syllables = "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le".split()
    made = lambda n: sorted({" " + "".join(rnd.choice(syllables) for _ in range(rnd.randrange(2, 8))) for _ in range(n)})
    b = bpe.PrefixBPE(Counting(ranks))
    merges, merged = [], b.merged
    b.merged = lambda data: merges.append(data) or merged(data)
    for w in made(5000):
        b.encode(w.encode())  # meets the tokens
    words = made(20_000)
    b.ranks.asked = 0
    got = [b.encode(w.encode()) for w in words]
    assert got == [want.encode_ordinary(w) for w in words]
    assert not merges
    assert b.ranks.asked < sum(map(len, words))


def test_bpe_under_edits(public):
    b = bpe.PrefixBPE(bpe.load_ranks(public.path("byte_bpe_multi_50k.tiktoken")))
    rnd = random.Random(2)
    for _ in range(60):
        e = bpe.Editable(b, bytes(rnd.choice(b"abcdefthn") for _ in range(200)))
        e.edit(rnd.randrange(200), rnd.randrange(3), bytes(rnd.choice(b"abth") for _ in range(rnd.randrange(4))))
        e.append(b"tion")
        assert e.last == b.table(e.data)


def test_encode_and_decode_tables(spark, public):
    name = "byte_bpe_multi_50k.tiktoken"
    got = bpe.encode_texts(docs(spark, ODD), name, public.PATTERN)
    back = {r.id: bytes(r.data) for r in bpe.decode_ids(got, name, public.PATTERN).collect()}
    assert back == {i: (t or "").encode() for i, t in enumerate(ODD)}


def test_library_pieces(public, strings):
    import tokenizers

    path = public.path("byte_bpe_50k.json")
    lib, own = tokenizers.Tokenizer.from_file(path), token_files.LibraryEncoder(path)
    for k in range(0, len(strings), 150):
        part = strings[k : k + 150]
        ids, bounds = own.encode(part)
        for t, a, b in zip(part, bounds, bounds[1:], strict=False):
            assert ids[a:b].tolist() == lib.encode(t, add_special_tokens=False).ids
    assert own.encode([])[0].size == 0


def test_library_pieces_of_many_words(public):
    """Words that are encoded together, in a small cache, and a very long text."""
    import tokenizers

    rnd = random.Random(12)
    path = public.path("byte_bpe_50k.json")
    lib, own = tokenizers.Tokenizer.from_file(path), token_files.LibraryEncoder(path, limit=50)
    texts = [" ".join("".join(rnd.choice("abcé日,.'") for _ in range(rnd.randrange(1, 9))) for _ in range(n)) for n in (1, 400, 30_000, 200_000, 0)]
    ids, bounds = own.encode(texts)
    assert len(bounds) == len(texts) + 1
    for t, a, b in zip(texts, bounds, bounds[1:], strict=False):
        assert ids[a:b].tolist() == lib.encode(t, add_special_tokens=False).ids


def test_elias_fano():
    rnd = random.Random(4)
    for n, top in ((0, 1), (1, 1), (5, 2), (1000, 10), (1000, 10**12), (70_000, 10**6)):
        values = np.array(sorted(rnd.randrange(top) for _ in range(n)), np.uint64)
        ef, end = elias_fano.EliasFano.from_bytes((data := elias_fano.EliasFano.encode(values).to_bytes()))
        assert end == len(data) and (ef.all() == values).all()
        for i in rnd.sample(range(n), min(n, 40)):
            assert ef[i] == values[i]
        if n > 100:
            assert len(data) * 8 <= n * (3 + np.log2(max(2, top / n))) + 400


def test_token_files(spark, public):
    import tokenizers

    lib = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    ids = [*range(100, 100 + len(ODD) - 2), 100, None]
    shards = token_files.write_shards(docs(spark, ODD, ids).repartition(5), "byte_bpe_50k.json")
    got = [tuple(r) for r in token_files.read_shards(shards).collect()]
    order = sorted(zip(ids, ODD, strict=True), key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    want, start = [], 0
    for i, t in order:
        x = [*lib.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((i, start, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        start += len(x)
    assert Counter(got) == Counter(want)
    assert token_files.read_shards(token_files.write_shards(empty(spark), "byte_bpe_50k.json")).count() == 0


def test_shard_random_access(spark, public, tmp_path):
    with open(tmp_path / "s", "wb") as f:
        w = token_files.ShardWriter(f, np.dtype("<u2"))
        for i, x in ((None, [1]), (-5, []), (7, [2, 3])):
            w.add(i, np.array(x, "<u2").tobytes())
        w.close()
    with open(tmp_path / "s", "rb") as f:
        s = token_files.Shard(f, (tmp_path / "s").stat().st_size)
        assert [(s.doc_id(i), s.tokens(i).tolist()) for i in (2, 0, 1)] == [(7, [2, 3]), (None, [1]), (-5, [])]


# 7


def test_loser_tree():
    rnd = random.Random(5)
    for k in range(12):
        runs = [sorted(rnd.randrange(30) for _ in range(rnd.randrange(9))) for _ in range(k)]
        assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)


def test_warc_round_trip(spark):
    big, other = "é" * 600, "y" * 1000
    rows = [(1, "http://B.org/x y\n", big), (2, "http://a.org/1", big), (3, None, "s"), (4, "http://a.org/1", "s"), (5, "::", None), (6, "http://www.a.org/0", other), (2, "http://a.org/1", big), (None, "u", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    index = warc.merge_index(warc.write_archives(warc.decide(pages)))
    got = warc.read_archives(index, with_payload=True).collect()
    assert Counter((r.id, r.n, r.digest, r.kind, r.refers) for r in got) == Counter(
        (i, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest(), "revisit" if h == big and i != 2 else "response", 2 if h == big and i != 2 else None) for i, _, h in rows
    )
    order = [r.key for r in index.orderBy("part", "place").collect()]
    assert order == sorted(order) and len(order) == len(rows)
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.merge_index(warc.write_archives(warc.decide(none)))).count() == 0


# 4


def covered(rows, window):
    words = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[a : a + window]) for w in words for a in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = {j for a in range(len(w) - window + 1) if seen[tuple(w[a : a + window])] > 1 for j in range(a, a + window)}
        kept = [x for j, x in enumerate(w) if j not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("window", [4, 7, 35])
def test_repeats(spark, window):
    rnd = random.Random(window)
    vocabulary = [f"w{i}" for i in range(40)] + ["ñ", "\x1c"]
    passages = [[rnd.choice(vocabulary) for _ in range(rnd.randrange(1, 3 * window))] for _ in range(6)]
    rows = []
    for i in range(150):
        w = []
        for _ in range(rnd.randrange(4)):
            w += rnd.choice(passages) if rnd.random() < 0.4 else [rnd.choice(vocabulary) for _ in range(rnd.randrange(2 * window))]
        rows.append((i, (" " if i % 3 else "\n ").join(w)))
    rows += [(900, None), (901, ""), (902, " ".join(["a"] * 4 * window)), (5, rows[5][1]), (None, rows[7][1])]
    got = substring_dedup.repeats(docs(spark, [t for _, t in rows], [i for i, _ in rows]).repartition(3), window).collect()
    assert Counter((r.id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == covered(rows, window)


def test_windows_of_one_hash_are_told_apart_by_the_second():
    by = substring_dedup.Exchange(3, 2, short=False)
    first, second, text = (np.array(x, np.uint64) for x in ([7, 7, 7, 9], [1, 2, 1, 1], [0, 1, 2, 3]))
    yes = np.ones(4, bool)
    here = list(by.pack(first, yes, text.astype(np.int64), np.arange(4), second))
    assert sorted(t for k, _, d in here if k == 2 for t in substring_dedup._places([d])) == [0, 2]
    there = list(by.pack(first[1:2], yes[:1], np.array([8]), np.array([5]), second[1:2])) + list(by.pack(first[3:], yes[:1], np.array([9]), np.array([6]), np.array([3], np.uint64)))
    found = [d for bucket in range(3) for _, _, d in by.settle([(k, d) for k, b, d in here + there if k < 2 and b == bucket])]
    assert {t: p.tolist() for t, p in substring_dedup._places(found).items()} == {1: [1], 8: [5]}


def test_repeats_empty(spark):
    assert substring_dedup.repeats(empty(spark)).count() == 0


# 9


def brute_components(rows, n, num, den):
    sets = {}
    for i, t in rows:
        w = low(t).split()
        k = min(n, len(w))
        sets[i] = {tuple(w[a : a + k]) for a in range(len(w) - k + 1)} if w else set()
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, x in sets.items():
        for j, y in sets.items():
            if j < i and x and den * len(x & y) >= num * len(x | y):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize(("n", "num", "den", "block"), [(3, 9, 10, 24), (5, 4, 5, 200), (2, 1, 2, 16)])
def test_jaccard(spark, n, num, den, block):
    rnd = random.Random(6)
    words = [f"w{i}" for i in range(200)]
    base = [rnd.choice(words) for _ in range(70)]
    rows = []
    for i in range(160):
        w = list(base)
        for _ in range(rnd.randrange(5)):
            w[rnd.randrange(70)] = rnd.choice(words)
        rows.append((i, " ".join(w[: rnd.randrange(1, 71)] if rnd.random() < 0.3 else w)))
    rows += [(200 + i, " ".join(rnd.choice(words[:5]) for _ in range(rnd.randrange(8)))) for i in range(60)]
    rows += [(300 + i, t) for i, t in enumerate(ODD)]
    got = jaccard.jaccard_components(docs(spark, [t for _, t in rows], [i for i, _ in rows]).repartition(3), n, num, den, block=block).collect()
    assert {r.id: (r.n_shingles, r.component) for r in got} == brute_components(rows, n, num, den)


@pytest.mark.parametrize("grams", [400, 10**9])
def test_jaccard_of_chained_texts(spark, monkeypatch, grams):
    """A long chain of texts that share rare words with the next: one component to search, many to find, by either way."""
    monkeypatch.setattr(jaccard, "BLOCK_GRAMS", grams)
    rnd = random.Random(18)
    rows = []
    for i in range(300):
        w = [f"v{i}x{k}" for k in range(12)] + [f"v{i + 1}x{k}" for k in range(12)]
        rows.append((i, " ".join(w)))
        if i % 5 == 0:
            w[rnd.randrange(24)] = "other"
            rows.append((1000 + i, " ".join(w)))
    got = jaccard.jaccard_components(docs(spark, [t for _, t in rows], [i for i, _ in rows]).repartition(3), 1, 4, 5, block=40).collect()
    assert {r.id: (r.n_shingles, r.component) for r in got} == brute_components(rows, 1, 4, 5)


def test_jaccard_nulls_repeats_empty(spark):
    got = jaccard.jaccard_components(docs(spark, ["a b c", "a b c", "a b c", None], [None, 4, 4, 5])).collect()
    assert Counter((r.id, r.n_shingles, r.component) for r in got) == Counter([(None, 1, None), (4, 1, 4), (4, 1, 4), (5, 0, 5)])
    assert jaccard.jaccard_components(empty(spark)).count() == 0


def test_prefixes_meet():
    """Sets at the very threshold share an n-gram of their prefixes, whatever the groups, for sizes of all kinds."""
    rnd = np.random.default_rng(7)
    for num, den in ((9, 10), (4, 5), (1, 2)):
        for size in (1, 2, 3, 4, 5, 9, 17, 40, 90, 333):
            for _ in range(10):
                words = [b"%d" % x for x in rnd.integers(0, 1 << 40, size)]
                cut_off = (den - num) * size // den
                texts = [b" ".join(words), b" ".join(words[cut_off:]), b" ".join(words[: size // 3])]
                groups = [jaccard.Group([k], [t], 1, 4) for k, t in enumerate(texts)]
                asked = {}
                for g, group in enumerate(groups):
                    for bucket, data in group.ask():
                        asked.setdefault(bucket, []).append((g, data))
                answers = {0: [], 1: [], 2: []}
                for bucket, rows in asked.items():
                    for (g, _), level in zip(rows, jaccard.how_common([d for _, d in rows]), strict=True):
                        answers[g].append((bucket, level))
                first, second = (groups[g].prefixes(answers[g], num, den)[0] for g in (0, 1))
                assert np.intersect1d(first, second).size
                assert max(len(first), len(second)) <= size - -(-num * size // den) + 1


def test_grams_of_one_text_lead_nowhere():
    group = jaccard.Group([1, 2, 3, 4], [b"a b c d e f", b"a b c d e f", b"a x y z q p", None], 1, 4)
    assert group.same == [(2, 1)] and group.sizes == [(1, 6), (2, 6), (3, 6), (4, 0)] and group.nodes == [1, 3]
    rows = list(group.ask())
    answers = [(k, level) for k, d in rows for level in jaccard.how_common([d])]
    assert len(group.prefixes(answers, 4, 5)[0]) == 0 and len(group.prefixes(answers, 1, 6)[0]) == 2


def test_windows_hash_words_not_spaces():
    a = shingles.windows(b"a b  c a b c".split(), 2)
    assert a[0] == a[3] and len(set(a.tolist())) == 3


# 2


@pytest.mark.parametrize("most", [4096, 7])
def test_near_vectors(spark, most):
    rnd = np.random.default_rng(8)
    base = rnd.normal(size=(12, 16))
    rows = []
    for i in range(240):
        v = base[i % 12] + rnd.normal(size=16) * rnd.choice([0, 0.05, 0.2, 0.4])
        rows.append((i, [float(np.float32(x)) for x in v], i % 3))
    rows += [(300, None, 1), (301, [0.0] * 16, 1), (302, [1.0, None], 1), (303, [float("nan")] * 16, 0), (304, rows[0][1], None), (305, rows[0][1][:8], 0), (306, [], 0), (307, rows[3][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.id: (r.n_links, r.component, r.kept) for r in embedding_dedup.near_vectors(df, most=most).collect()}
    ok = {i: np.array(v) for i, v, y in rows if v and y is not None and None not in v and np.isfinite(v).all() and any(v)}
    label = {i: y for i, _, y in rows}
    links = {i: [j for j in ok if j != i and i in ok and label[i] == label[j] and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] / np.linalg.norm(ok[i]) / np.linalg.norm(ok[j]) >= 0.93] for i in label}
    for i in label:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        assert got[i] == (len(links[i]), min(seen), i == min(seen))


def test_near_vectors_empty(spark):
    assert embedding_dedup.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


@pytest.mark.parametrize("task_mb", [4.0, 1e-4])
def test_components(spark, monkeypatch, task_mb):
    from lakesieve.llm import graph

    monkeypatch.setattr(graph, "TASK_MB", task_mb)
    rnd = random.Random(9)
    pairs = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(300)] + [(i, i + 1) for i in range(500, 560)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    for x in got:
        seen, todo = {x}, [x]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        assert got[x] == min(seen)


# 1 and 3


def test_language_id(spark):
    rnd = random.Random(10)
    sound = {"aa": ["the", "ing", "and", "wh", "sh"], "bb": ["ung", "sch", "ich", "der", "ß"], "cc": ["ción", "que", "los", "ado"]}
    rows = [(i, " ".join("".join(rnd.choice(sound[k]) for _ in range(3)) for _ in range(30)), k) for i in range(600) for k in [rnd.choice(list(sound))]]
    rows += [(900, None, "aa"), (901, "123 !!", "aa"), (902, "", None), (None, "the and", "bb"), (3, rows[3][1], "cc")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.identify(df, langid.train(df, per_language=100)).collect()
    assert len(got) == len(rows)
    by = {r.id: r for r in got}
    assert [(by[i].lang_pred, by[i].score) for i in (900, 901, 902)] == [("und", 0.0)] * 3
    held = [(by[i].lang_pred, k) for i, _, k in rows[:600] if by[i].held_out]
    assert len(held) > 100 and sum(a == b for a, b in held) >= 0.98 * len(held)
    assert all(r.held_out == (r.id is not None and zlib.crc32(str(r.id).encode()) % 3 == 1) for r in got)
    assert [r.lang_pred for r in langid.identify(df, None).collect()] == ["und"] * len(rows)


def test_toxicity_chain(spark):
    rnd = random.Random(11)
    words = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(900):
        bad, poor = rnd.random() < 0.2, rnd.random() < 0.3
        w = [rnd.choice(words) for _ in range(40)] + ["vileness!"] * bad + ["junk", "###"] * poor
        rnd.shuffle(w)
        rows.append((i, " ".join(w)))
        if i < 700:
            labels.append((i, 0 if poor else 1, int(bad)))
    rows += [(1000, None), (1001, " "), (1002, "... !!"), (None, "vileness")]
    labels += [(3, None, 1), (None, 1, 1), (5000, 1, 1)]
    df, lab = docs(spark, [t for _, t in rows], [i for i, _ in rows]), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    chain = toxicity.train(df, lab, {"low_quality": "1 - quality", "toxic": "toxic"}, sample=500)
    got = {r.id: r for r in toxicity.classify(df, chain, keep=("text", "id")).collect()}
    wrong = sum(got[i].toxic != ("vileness!" in t) for i, t in rows[700:900])
    assert wrong <= 2 and [got[i].p_toxic for i in (1000, 1001, 1002)] == [0.0] * 3 and got[None].toxic
    assert got[0].keep_text == rows[0][1] and got[0].keep_id == 7
    none = toxicity.train(df, lab.limit(0), {"toxic": "toxic"})
    assert toxicity.classify(df, none).where("toxic").count() == 0


def test_toxicity_against_brute_force(spark):
    """Every probability, computed again text by text from the fitted weights without the operator's caches and columns."""
    import math

    rnd = random.Random(12)
    words = [f"word{i}" for i in range(200)]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(30)) + (" vile vileness" if i % 6 == 0 else "") + (" junk" if i % 5 == 0 else "")) for i in range(400)]
    lab = spark.createDataFrame([(i, int(i % 5 != 0), int(i % 6 == 0)) for i, _ in rows], "doc_id long, quality int, toxic int")
    rows += [(1000 + i, t) for i, t in enumerate(ODD)] + [(2000, "word1 " * 200_000 + "vileness"), (5, rows[5][1])]
    df = docs(spark, [t for _, t in rows], [i for i, _ in rows])
    chain = toxicity.train(df, lab, {"low_quality": "1 - quality", "toxic": "toxic"})
    assert len(chain.models[1].bits) and len(chain.models[1].earlier) == 1
    got = Counter((r.id, round(r.p_low_quality, 5), round(r.p_toxic, 5), r.toxic) for r in toxicity.classify(df, chain).collect())
    want = Counter()
    for i, t in rows:
        on = {b for w in (t or "").lower().split() for b in toxicity.word_bits(w)}
        p = []
        for m in chain.models:
            z = m.bias + sum(float(w) for b, w in zip(m.bits.tolist(), m.weights, strict=True) if b in on) + sum(float(w) * q for w, q in zip(m.earlier, p, strict=True))
            p.append(1 / (1 + math.exp(-z)) if on else 0.0)
        want[i, round(p[0], 5), round(p[1], 5), p[1] >= chain.threshold] += 1
    assert got == want and any(k[0] == 2000 and k[3] for k in got)


def test_toxicity_learns_one_row_an_id(spark):
    df = docs(spark, ["a vile text", "a good text"] * 3, [1, 2] * 3).union(docs(spark, [None, "x"], [1, None]))
    lab = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    a, b = (toxicity.train(d, lab, {"toxic": "toxic"}) for d in (df, df.repartition(5)))
    assert a.models[0].bias == b.models[0].bias and a.threshold == b.threshold


def test_language_id_against_brute_force(spark, monkeypatch):
    """Counts by plain loops and cosines centroid by centroid; the steps of very long texts are crossed."""
    import math

    rnd = random.Random(13)
    sound = {"aa": ["the", "ing", "and", "wh"], "bb": ["ung", "sch", "ich", "ß"]}
    rows = [(i, " ".join("".join(rnd.choice(sound[k]) for _ in range(3)) for _ in range(12)), k) for i in range(120) for k in [rnd.choice(list(sound))]]
    rows += [(500 + i, t, None) for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(df, per_language=30, clusters=2)
    got = {r.id: (r.lang_pred, r.score) for r in langid.identify(df, model).collect()}

    def plain(t):
        data, c = t.encode().translate(langid._FOLD, langid._DROP), [0] * langid.DIMS
        for n in (1, 2, 3):
            for a in range(len(data) - n + 1):
                code = 0
                for x in data[a : a + n]:
                    code = code * 257 + x
                c[((code + n) * 0x9E3779B1 & 0xFFFFFFFF) >> 32 - langid.DIMS_BITS] += 1
        return c

    for i, t, _ in rows:
        if not t or not any(ch.isalpha() for ch in t):
            assert got[i] == ("und", 0.0)
            continue
        v = [math.log1p(c) * w for c, w in zip(plain(t), model.idf, strict=True)]
        norm = math.sqrt(sum(x * x for x in v)) or 1
        sims = [sum(x * float(y) for x, y in zip(v, center, strict=True) if x) / norm for center in model.centers]
        best = max(range(len(sims)), key=lambda k: sims[k])
        assert abs(got[i][1] - max(0.0, sims[best])) < 1e-4
        assert got[i][0] == model.languages[model.owner[best]] or sorted(sims)[-1] - sorted(sims)[-2] < 1e-5
    long = rows[0][1].encode() * 20
    whole = langid.counts(long)
    monkeypatch.setattr(langid, "STEP", 64)
    assert (langid.counts(long) == whole).all() and (plain(long.decode()) == whole).all()


def test_language_id_learns_bounded_rows(spark):
    rows = [(1, "wh the and", "aa")] * 50 + [(i, f"ung sch {i}", f"l{i:02}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(df, languages=3)
    assert len(model.languages) == 3 and "aa" in model.languages
    assert langid.identify(df.withColumnRenamed("lang", "held_out"), model).count() == len(rows)


def test_windows_cross_steps(monkeypatch):
    words = [f"w{i % 7}".encode() for i in range(1000)]
    whole = shingles.windows(words, 5)
    monkeypatch.setattr(shingles, "STEP", 33)
    assert (shingles.windows(words, 5) == whole).all()


def test_jaccard_long_texts(spark):
    rnd = random.Random(14)
    w = [f"w{rnd.randrange(5000)}" for _ in range(150_000)]
    near = list(w)
    for k in range(0, 150_000, 100):
        near[k] = "other"
    got = {r.id: r.component for r in jaccard.jaccard_components(docs(spark, [" ".join(w), " ".join(near), " ".join(w[:100_000]), "short"]), 5, 4, 5).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 3}


def test_prefix_tree_of_nested_sets():
    chain = [np.arange(n) for n in range(1, 3000)]
    tree = jaccard.PrefixTree(chain)
    inside = np.ones(3000, bool)
    assert len(list(tree.matches(inside, 2999, 9, 10, lambda i: False))) == len([n for n in range(1, 3000) if 10 * n >= 9 * 2999])


def test_mix_by_weights_and_repeats(spark):
    rnd = random.Random(17)
    rows = [(i % 100, " ".join("w" * rnd.randrange(1, 40)), "a" if i % 3 else "b", float(i % 2) * 8 + 1) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, weight double")
    runs = [Counter((r.id, r.source, r.size, r.taken) for r in mixing.pareto_mix(df.repartition(k)).collect()) for k in (2, 7)]
    assert runs[0] == runs[1]
    got = mixing.pareto_mix(df.withColumn("doc_id", df.doc_id * 0).withColumn("a.b", df.weight), weight_col="weight", keep=("a.b", "weight"), seed="s").collect()
    extra = {s: [(r.weight, r.copies - min(x.copies for x in got if x.source == s)) for r in got if r.source == s] for s in ("a", "b")}
    assert all(r["a.b"] == r.weight for r in got)
    heavy, light = ([c for pairs in extra.values() for w, c in pairs if w == k] for k in (9.0, 1.0))
    assert sum(heavy) >= sum(light)
    for s in ("a", "b"):
        mine = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 40


def test_entries_take_whole_tables(spark):
    """Each registered query on the smallest tables: as many rows as its table, and equal to the operators' own digests."""
    from lakesieve.llm import registry

    at = "/root/testdata/sf0.001"
    of = {"op2": "embeddings", "op7": "pages"}
    for name, query in registry.queries().items():
        table = spark.read.parquet(f"{at}/{of.get(name.split('_')[0], 'documents')}.parquet")
        assert query(spark, at).count() == table.count(), name


def test_bpe_digests_of_the_query(spark, public):
    import tiktoken

    from lakesieve.llm import registry

    at = "/root/testdata/sf0.001"
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    lib = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for r in spark.read.parquet(f"{at}/documents.parquet").collect():
        ids = lib.encode_ordinary(r.text or "")
        want[r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in registry.op6_byte_bpe(spark, at).collect()) == want


def test_warc_runs_stay_ordered(spark):
    """Captures of one page at several times stand in order of their dates; odd columns are ignored."""
    from datetime import datetime

    rows = [(i, f"http://h{i % 7}.org/{i % 3}", None if i % 11 == 0 else f"p{i}", datetime(2024, 1, 1 + i % 28), "x") for i in range(500)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, seen timestamp, key string").repartition(9)
    index = warc.merge_index(warc.write_archives(warc.decide(pages, date_col="seen")))
    got = [(r.key, r.date, r.id) for r in index.orderBy("part", "place").collect()]
    assert got == sorted(got) and len(got) == 500 and len({d for _, d, _ in got}) == 28
