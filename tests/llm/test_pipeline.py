"""The pipeline and each of its stages against brute force, on odd tables too."""

import base64
import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"long{i % 977}word{i}" for i in range(60_000))


def corpus():
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(40):
        w = [rnd.choice(words) for _ in range(rnd.randrange(30, 60))]
        rows.append((5 * i, " ".join(w)))
        rows.append((5 * i + 1, " ".join(w).upper() if i % 3 == 0 else " ".join(w[:-1] + ["new"])))
        if i % 4 == 0:
            rows.append((5 * i + 2, " ".join(w)))
        if i % 2 == 0:
            rows.append((5 * i + 3, " ".join(rnd.choice(words) for _ in range(25)) + " vileness!" * (i % 4 == 0)))
    rows += [(900, None), (901, ""), (902, LONG), (903, LONG + " end"), (904, "é ß  日本語")]
    return [(i, t, "en", ["a", "b", None][i % 3], len(t or "")) for i, t in rows]


def labels(spark, rows):
    return spark.createDataFrame([(r[0], 1, int("vileness" in (r[1] or ""))) for r in rows], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("corpus"))
    rows = corpus()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{at}/documents.parquet")
    labels(spark, rows).write.parquet(f"{at}/labels.parquet")
    return at


def brute_toxicity(rows, chain):
    from lakesieve.llm.toxicity import word_bits

    out = []
    for r in rows:
        on = {b for w in (r[1] or "").lower().split() for b in word_bits(w)}
        p = []
        for m in chain.models:
            z = m.bias + sum(float(w) for b, w in zip(m.bits.tolist(), m.weights, strict=True) if b in on) + sum(float(w) * q for w, q in zip(m.earlier, p, strict=True))
            p.append(1 / (1 + math.exp(-z)) if on else 0.0)
        if p[-1] < chain.threshold:
            out.append(r)
    return out


def brute_exact(rows):
    best = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        best[(r[1] or "").encode().lower()] = r
    return list(best.values())


def brute_near(rows):
    sets = {}
    for r in rows:
        w = (r[1] or "").encode().lower().split()
        k = min(5, len(w))
        sets[r[0]] = {tuple(w[a : a + k]) for a in range(len(w) - k + 1)} if w else set()
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, x in sets.items():
        for j, y in sets.items():
            if j < i and x and 5 * len(x & y) >= 4 * len(x | y):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return [r for r in rows if find(r[0]) == r[0]]


def brute_mix(rows):
    size = {id(r): len((r[1] or "").encode().split()) for r in rows}
    of = defaultdict(list)
    for r in rows:
        of[r[3]].append(r)
    names = sorted(s for s in of if s is not None) + [None] * (None in of)
    total = {s: sum(size[id(r)] for r in of[s]) for s in names}
    target, free, left = {}, set(names), float(sum(total.values()))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * total[s]} or free
        for s in over:
            target[s] = min(3.0 * total[s], level * weight[s])
        left -= sum(target[s] for s in over)
        free = free - over
    out = []
    for s in names:
        share = target[s] / total[s] if total[s] else 0.0
        whole, done = math.floor(share), 0
        rest = target[s] - whole * total[s]

        def odds(r):
            u = (int(hashlib.md5(f"mix-1{r[0]}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            return u / (1 - u)

        for r in sorted(of[s], key=odds):
            done += size[id(r)]
            out += [r] * (whole + (share > whole and done - size[id(r)] / 2 <= rest))
    return out


def brute_bpe(rows):
    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return [(r[0], tuple(lib.encode_ordinary(r[1] or ""))) for r in rows]


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_stages_and_run(spark, folder):
    from lakesieve.llm import toxicity

    docs, rows = spark.read.parquet(f"{folder}/documents.parquet"), corpus()
    chain = toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet"), corpus_pipeline.TOXICITY)
    want = brute_toxicity(rows, chain)
    assert rows_of(corpus_pipeline.toxicity(spark, docs, folder)) == Counter(want) and 0 < len(rows) - len(want) <= 12
    assert rows_of(corpus_pipeline.exact_dedup(spark, docs, folder)) == Counter(brute_exact(rows)) != Counter(rows)
    assert rows_of(corpus_pipeline.near_dedup(spark, docs, folder)) == Counter(brute_near(rows)) != Counter(rows)
    assert rows_of(corpus_pipeline.mixing(spark, docs, folder)) == Counter(brute_mix(rows)) != Counter(rows)
    got = Counter((r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, folder).collect())
    assert got == Counter(brute_bpe(brute_mix(brute_near(brute_exact(want)))))


def test_stages_take_odd_tables(spark, tmp_path):
    """Extra columns with the names that stages use themselves, dots among them, nulls, repeated rows, no rows."""
    names = ["doc_id", "text", "lang", "source", "n_chars", "_id", "id", "row", "keep_text", "size", "a.b"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _id long, id string, row string, keep_text int, size string, `a.b` string"
    more = (7, "x", "r", 1, "s", "dot")
    rows = [(1, "a b c d e f", "en", "s", 3, *more), (1, "A b c d e f", "en", "s", 3, *more), (1, "a b c d e f", "en", "s", 3, *more), (2, "other words here", None, None, None, *[None] * 6), (None, None, None, None, None, *[None] * 6), (None, "q r s", "en", "s", 1, *more), (3, None, "en", "s", 0, *more), (4, LONG, "en", "t", 0, *more)]
    labels(spark, [(1, "a"), (2, "vileness")]).write.parquet(f"{tmp_path}/labels.parquet")
    df = spark.createDataFrame(rows, schema).repartition(2)
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, df, str(tmp_path))
        none = stage(spark, spark.createDataFrame([], schema), str(tmp_path))
        assert none.count() == 0
        if name == "byte_bpe":
            assert got.count() == len(rows) and got.columns == ["doc_id", "n_tokens", "ids"] == none.columns
            continue
        assert got.columns == names == none.columns
        left = rows_of(got)
        assert set(left) <= set(rows)
        if name == "exact_dedup":
            assert sum(left.values()) == 5 and sum(r[0] == 1 for r in left.elements()) == 1 and sum(r[1] is None for r in left.elements()) == 1
        if name in ("toxicity", "ngram_jaccard"):
            assert left == Counter(rows)


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_jaccard", "mixing", "byte_bpe"]
