"""The operators against brute force, SQL and the tokenizer libraries, on small tables with awkward rows."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from chatnorm.llm import (
    exact_dedup,
    mixing,
    near_dup,
    piece_sampling,
    queries,
    secrets,
    substring_dedup,
    token_counts,
    topk_search,
    toxicity,
    url_filter,
)
from chatnorm.llm.common import mix64
from oracle import connect, differences

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, score int, digest string"


def words(n, seed, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Copies, near copies, a group of them, shared passages, nulls, empty, short and long texts, repeated rows."""
    base, passage = words(120, 1), words(40, 2)
    out = [(1, base), (2, base), (3, base.upper()), (4, None), (5, ""), (6, "  \n\t"), (7, "a b c"), (8, "A  b\nc"), (9, "a b")]
    r = random.Random(3)
    for i in range(10, 60):  # a group around one text, less alike among each other
        w = base.split()
        for _ in range(2):
            w[r.randrange(len(w))] = f"x{r.randrange(1000)}"
        out.append((i, " ".join(w)))
    out += [(60 + i, f"{words(30, 50 + i)} {passage} {words(30, 90 + i)}") for i in range(6)]
    out += [(70, words(9000, 7, 10**6)), (71, "é" * 70 + passage), (72, "=" * 300), (73, passage), (None, base), (None, None)]
    out += [(1, base), (74, "日本語 𐍈 <|endoftext|> don't 'S")]
    return [(i, t, "en", f"s{(i or 0) % 3}" if i != 9 else None, None, True, 1, "x") for i, t in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def pairs_of(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_equals_sql(spark, name):
    mine = queries.QUERIES[name](spark, SF_DIR).toPandas()
    assert differences(mine, connect(SF_DIR).execute(queries.SQL[name]).df()) is None


# Token counts.


def test_prefix_counts_are_those_of_the_library(rows):
    counter = token_counts.counter(token_counts.tokenizer_path())
    odd = ["don't we're 'll", "<|endoftext|>x a!<|startoftext|>b<|endoft", "e\u0301 Å İs ΑΣ", "1²½Ⅷ", "a\u00a0b\x1cc", "---!! aaa", " \n x "]
    for text in [*odd, *(t[:90] for _, t, *_ in rows if t)]:
        counts = counter.prefixes(text)
        library = [len(counter._library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        assert counts.tolist() == library, text


def test_token_counts_of_rows(docs, nothing, rows):
    found = token_counts.prefix_tokens(docs, budget=10).collect()
    library = token_counts.counter(token_counts.tokenizer_path())._library
    expected = Counter((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in rows)
    assert Counter((r["doc_id"], r["n_bytes"], r["prefix_tokens"][-1]) for r in found) == expected
    assert all(r["prefix_tokens"][r["kept_chars"]] <= 10 for r in found)
    assert token_counts.prefix_tokens(nothing).count() == 0


# Toxicity.


def test_restoring_disguised_words():
    text = "the idiot moron stupid loser clown trash word " * 50
    classes = toxicity.letter_classes("\n\n" + text + "\n\n")
    triples = Counter(((classes[:-2] * 28 + classes[1:-1]) * 28 + classes[2:]).tolist())
    reader = toxicity.Reader(triples)
    for spelled, word in (("1d10t", "idiot"), ("m0r0n", "moron"), ("$tup1d", "stupid"), ("l-o-s-e-r", "loser"), ("c l 0 w n", "clown"), ("trrrrash", "trash")):
        assert word in reader.words(f"the {spelled} word"), spelled
    assert reader.words("plain words, here.") == {"plain", "words", "here"}
    # Viterbi against all paths.
    restorer = reader.restorer

    def best(span):
        scores = []
        for path in itertools.product(*restorer.lattice(span)):
            a = b = 0
            score = sum(channel for _, channel in path)
            for k in itertools.chain(*(c for c, _ in path)):
                if not a == b == k == 0:
                    score += restorer.log[a][b][k]
                a, b = b, k
            text = "".join(chr(96 + k) if k else " " for c, _ in path for k in c)
            scores.append((score + restorer.log[a][b][0], text))
        return max(scores, key=lambda s: s[0])[1]

    for span in ("1d10t", "m0r0n", "c10wn!", "a.b-1"):
        assert restorer.restore(span) == best(span)


def test_toxicity_held_out(spark, docs, nothing):
    found = {r["doc_id"]: r for r in toxicity_query(spark)}
    labels = duckdb.sql(f"SELECT doc_id, toxic FROM '{SF_DIR.replace('0.001', '0.01')}/labels.parquet'").fetchall()
    held = [(found[i]["predicted"], y) for i, y in labels if found[i]["held_out"]]
    assert all(found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _ in labels)
    assert sum(p == y for p, y in held) / len(held) > 0.9 and not any(p and not y for p, y in held)
    model = toxicity.fit(nothing, spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert {r["score"] for r in toxicity.score(docs, model).collect()} == {0.0}
    assert toxicity.keep_harmless(docs, model).columns == docs.columns
    assert toxicity.keep_harmless(docs, model).count() == docs.count() and toxicity.score(nothing, model).count() == 0


def toxicity_query(spark):
    return queries.QUERIES["op2_toxicity"](spark, SF_DIR.replace("0.001", "0.01")).collect()


# URL filter.


def test_url_filter(spark):
    urls = ["http://a.org", "http://a.org/", None, "", "nothing", "HTTP://X.Example.ORG/es/1?q", "http://m.example.org/en/12", "http://b.com/fr/1#x",
            "http://b.com/de/", "http://www.bad.net/p.html", "http://bad.net/p/", "http://bad.net/q", "http://org/", "x://É.com/fr"]
    pages = spark.createDataFrame([(k, u, 1, "x") for k, u in enumerate([*urls, urls[9], urls[9]])], "page_id int, url string, verdict int, rule string")
    listed = spark.createDataFrame([("bad.net/p",), ("bad.net/p",), (None,)], "url string")
    got = [(r["host"], r["path"], r["rule"], r["verdict"]) for r in sorted(url_filter.judge(pages, listed).collect(), key=lambda r: r["page_id"])]
    assert got[:14] == [
        ("a.org", "", None, "allow"), ("a.org", "/", "org/", "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("x.example.org", "/es/1", "example.org/es/", "block"), ("m.example.org", "/en/12", "example.org/en/1", "block"), ("b.com", "/fr/1", "com/fr/", "allow"),
        ("b.com", "/de/", "com/de/", "block"), ("www.bad.net", "/p.html", None, "block"), ("bad.net", "/p/", None, "block"), ("bad.net", "/q", None, "allow"),
        ("org", "/", "org/", "allow"), ("É.com", "/fr", None, "allow"),
    ]
    assert got[14] == got[15] == got[9]
    assert url_filter.judge(pages.limit(0), listed).count() == 0
    assert {r["listed"] for r in url_filter.judge(pages, listed.limit(0)).collect()} == {False}


# Exact duplicates.


def test_cuckoo_index_grows_and_deletes():
    index, live = exact_dedup.CuckooIndex(2), {}
    r = random.Random(5)
    for step in range(6000):
        digest = hashlib.sha256(str(r.randrange(2500)).encode()).digest()
        if digest in live and r.random() < 0.5:
            assert index.delete(digest)[1] == live.pop(digest)
        elif digest not in live:
            assert index.get(digest) is None and index.delete(digest) is None
            live[digest] = step
            index.insert(digest, step)
    assert {e[0]: e[1] for e in index.live()} == live and index.size == len(live)
    assert index.buckets > 2 and all(index.get(d)[1] == v for d, v in live.items())


def test_exact_dedup(docs, nothing, rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    expected = Counter()
    for i, t, *_ in rows:
        g = groups[t or ""]
        keep = max((x for x in g if x is not None), default=None)
        expected[i, keep, len(g), i == keep] += 1
    assert pairs_of(exact_dedup.classes(docs), "doc_id", "keep_id", "group_size", "kept") == expected
    assert exact_dedup.classes(nothing).count() == 0
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {k[0] for k in expected if k[3]}
    rows_ = exact_dedup.digests(docs)
    index = exact_dedup.change_index(None, rows_)
    less = exact_dedup.change_index(index, deleted=rows_.where("doc_id = 73"))
    assert less.count() == index.count() - 1


# Mixing.


def test_mixing(spark, docs, nothing, rows):
    big = [(k, words(5 + k * 7 % 90, k), f"s{k % 7}" if k % 11 else None) for k in range(900)]
    frame = spark.createDataFrame([(i, t, s) for i, t, _, s, *_ in rows if i != 70] + [(1000 + k, t, s) for k, t, s in big], "doc_id bigint, text string, source string")
    got = mixing.mix(mixing.sized(frame)).collect()
    size = Counter()
    for r in got:
        size[r["source"]] += r["size"]
    names = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, total, full = {}, 1.5 * sum(size.values()), set()
    while True:  # share, stop at the most, share the excess again
        left = total - sum(2 * size[s] for s in full)
        open_ = sum(weight[s] for s in names if s not in full)
        target = {s: 2.0 * size[s] if s in full else left * weight[s] / open_ for s in names}
        over = {s for s in names if s not in full and target[s] > 2 * size[s]}
        if not over:
            break
        full |= over
    taken = Counter()
    for r in got:
        assert r["source_size"] == size[r["source"]] and math.isclose(r["target"], target[r["source"]], rel_tol=1e-9)
        assert r["copies"] in (0, 1, 2) and (r["size"] or not r["copies"])
        taken[r["source"]] += r["size"] * r["copies"]
    for s in names:
        assert abs(taken[s] - target[s]) <= max(2, 0.01 * target[s])
    assert len(got) == frame.count()
    again = mixing.mix(mixing.sized(frame.repartition(5)))
    assert pairs_of(again, "doc_id", "size", "copies") == Counter((r["doc_id"], r["size"], r["copies"]) for r in got)
    assert mixing.mix(mixing.sized(nothing)).count() == 0
    assert mixing.mixed(docs).columns == docs.columns


# Secrets.


def test_secrets(spark):
    key = "aZ3kQ9xLm2Vt8Rb5Yc1Wd7Ns4"
    texts = ["token=secret=abcdefgh1", "token: secret: abcdefghij", "PassWord = 'short'", f"x {key} y", "AKIA123 AKIAABCDEFGHIJKL12", "f" * 31, "0a" * 16,
             "123e4567-e89b-12d3-a456-426614174000 abcdefghijklmnopqrstuvwxyz012345", "one-two-three-four-five-six-7", None, "", "ſecret=abcdefgh12"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in secrets.secret_spans(frame).collect()}
    assert got[0] == [("assign", 0, 22)] and got[1] == [] and got[2] == [] and got[3] == [("entropy", 2, 27)]
    assert got[4] == [("access", 8, 26)] and got[5] == [] and got[6] == [("hex", 0, 32)]
    assert got[7] == got[8] == got[9] == got[10] == got[11] == []

    def direct(s):
        w, marked = secrets.WINDOW, set()
        for i in range(len(s) - w + 1):
            part = s[i : i + w]
            entropy = -sum(n / w * math.log2(n / w) for n in Counter(part).values())
            least = next(x for members, x in secrets.CLASSES if set(part) <= members)
            if entropy >= least - 1e-9:
                marked.update(range(i, i + w))
        return marked

    r = random.Random(1)
    for _ in range(50):
        s = "".join(r.choice("abcdef0123456789ABCxyz+/"[: r.choice((4, 16, 24))]) for _ in range(90))
        assert {p for a, b in secrets.entropy_windows(s) for p in range(a, b)} == direct(s)


# Near duplicates.


def components_by_force(rows):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = defaultdict(list)
    for i, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets[i].append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    root = {i: i for i in sets if i is not None}
    for a, b in itertools.combinations(root, 2):
        for x, y in itertools.product(sets[a], sets[b]):
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                one, two = sorted((root[a], root[b]))
                root = {k: one if v == two else v for k, v in root.items()}
    return sets, root


def test_near_duplicates(docs, nothing, rows):
    sets, root = components_by_force(rows)
    for r in near_dup.components(docs).collect():
        i = r["doc_id"]
        assert r["n_shingles"] in {len(s) for s in sets[i]}
        assert r["component_id"] == root.get(i) and r["kept"] == (i is None or root[i] == i)
    assert len({root[i] for i in range(10, 60)}) == 1
    assert near_dup.components(nothing).count() == 0
    assert near_dup.drop_near_copies(docs).columns == docs.columns


def test_signatures_estimate_similarity():
    a = " ".join(f"w{k}" for k in range(400))
    b = " ".join(f"w{k}" for k in range(40, 440))
    owner, found = near_dup.shingles([a, b])
    x, y = (set(found[owner == k].tolist()) for k in (0, 1))
    assert len(x & y) / len(x | y) == 356 / 436
    values = near_dup.signatures(np.searchsorted(owner, [0, 1]), found)
    assert abs((values[0] == values[1]).mean() - 356 / 436) < 0.12
    keys = near_dup.band_keys(values)
    assert keys.shape == (2, near_dup.BANDS) and 5 <= (keys[0] == keys[1]).sum() < near_dup.BANDS
    one, two = near_dup.bit_words(values)
    differ = sum(int(x ^ y).bit_count() for x, y in zip(one, two, strict=True))
    assert differ == ((values[0] ^ values[1]) & np.uint64(1)).sum() <= near_dup.binomial_limit(0.25)
    assert near_dup.binomial_limit(0.0) == 0 and 160 < near_dup.binomial_limit(0.25) < 190


# Repeated passages.


def test_repeated_passages(spark, docs, nothing, rows):
    plain = [(i, (t or "").encode()) for i, t, *_ in rows if i not in (None, 1)] + [(1, next(t for i, t, *_ in rows if i == 1).encode())]
    frame = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    expected = substring_dedup.brute_force(plain)
    got = substring_dedup.without_repeats(frame.repartition(4)).collect()
    assert len(got) == len(expected)
    for r in got:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) == expected[r["doc_id"]], r["doc_id"]
    every = substring_dedup.without_repeats(docs).collect()
    assert len(every) == len(rows) and sum(r["n_removed"] for r in every if r["doc_id"] == 1) == 0
    assert substring_dedup.without_repeats(nothing).count() == 0


# Top-k search.


def test_topk_search(spark):
    r = np.random.default_rng(2)
    vectors = [(k, [float(x) for x in r.normal(0, 0.3, 9)]) for k in range(300)]
    vectors += [(300 + k, vectors[0][1]) for k in range(20)]  # ties
    vectors += [(400, None), (401, [None] * 9), (402, [float("nan")] * 9), (403, [float("inf")] * 9), (404, []), (405, [0.5]), (None, [1.0] * 9), (7, vectors[7][1])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in vectors], "vec_id bigint, embedding array<float>, score int")
    q = topk_search.quantised(frame)
    rows = [(r["id"], r["v"]) for r in q.collect()]
    asked = [(i, v) for i, v in rows if i % 50 == 0]
    got = topk_search.search(topk_search.build_index(q, block_rows=64), q.where("id % 50 = 0"), 5).collect()
    expected = Counter()
    for i, v in asked:
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j) for j, w in rows if j != i)
        for rank, (s, j) in enumerate(scores[:5], 1):
            expected[i, rank, j, -s] += 1
    assert Counter(tuple(r) for r in got) == expected
    assert topk_search.search(topk_search.build_index(q.limit(0)), q, 5).count() == 0


# Sampled segmentations.


def test_samples_without_replacement():
    s = piece_sampling.sampler(piece_sampling.model_path(), 1.0)
    pieces = s.pieces

    def paths(text):
        normal = pieces.normal(text)

        def go(i):
            if i == len(normal):
                yield (), 0.0
                return
            ends = [j for j in range(i + 1, min(len(normal), i + pieces.longest) + 1) if normal[i:j] in pieces.ids]
            for j in ends:
                p = pieces.ids[normal[i:j]]
                for rest, log in go(j):
                    yield (p, *rest), pieces.log[p] + log
            if i + 1 not in ends:
                spelled = normal[i].encode()
                for rest, log in go(i + 1):
                    yield (*(pieces.bytes[b] for b in spelled), *rest), len(spelled) * pieces.log_byte + log

        return dict(go(0))

    for text, k in (("the", 3), ("ab cd", 3), ("x\n𐍈", 5), ("", 2)):
        every = paths(text)
        total = np.logaddexp.reduce(list(every.values()))
        p = {q: math.exp(log - total) for q, log in every.items()}
        n, firsts, seconds = 3000, Counter(), Counter()
        for found in s.sample(mix64(np.arange(n).astype(np.uint64)), [text] * n, k):
            drawn = [tuple(pieces.spell(x[2]).tolist()) for x in found[:-1]]
            assert len(set(drawn)) == len(drawn) == min(k, len(every))
            assert [x[1] for x in found] == sorted((x[1] for x in found), reverse=True)
            assert all(math.isclose(x[0], every[d] - total, abs_tol=1e-6) for x, d in zip(found[:-1], drawn, strict=True))
            firsts[drawn[0]] += 1
            if len(drawn) > 1:
                seconds[drawn[1]] += 1
        for q in p:
            assert abs(firsts[q] / n - p[q]) < 0.03
            second = sum(p[o] * p[q] / (1 - p[o]) for o in p if o != q and p[o] < 1)
            assert len(p) == 1 or abs(seconds[q] / n - second) < 0.03


def test_pieces_decode_to_the_text(docs, nothing, rows):
    samples = piece_sampling.sample_pieces(docs, k=2)
    decoded = pairs_of(piece_sampling.decode_pieces(samples), "doc_id", "rank", "decoded")
    expected = Counter()
    for i, t, *_ in rows:
        expected[i, 1, t or ""] += 1
        if t:
            expected[i, 2, t] += 1
    assert decoded == expected
    again = piece_sampling.sample_pieces(docs.repartition(7), k=2)
    key = lambda f: Counter((r["doc_id"], r["rank"], tuple(r["pieces"])) for r in f.collect())
    assert key(again) == key(samples)
    assert piece_sampling.sample_pieces(nothing).count() == 0


# Pipeline.


def test_pipeline_against_its_parts(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    harmless = stages["toxicity"](spark, docs, SF_DIR)
    assert harmless.columns == docs.columns
    latest = {text[r["doc_id"]]: r["doc_id"] for r in sorted(harmless.collect(), key=lambda r: r["doc_id"])}
    single = stages["exact_dedup"](spark, harmless, SF_DIR)
    assert {r["doc_id"] for r in single.collect()} == set(latest.values())
    _, root = components_by_force([(i, text[i]) for i in latest.values()])
    near = stages["near_dedup"](spark, single, SF_DIR)
    assert sorted(r["doc_id"] for r in near.collect()) == sorted(set(root.values()))
    mixed = stages["mixing"](spark, near, SF_DIR).collect()
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(mixing.sized(near)).collect()}
    assert Counter(r["doc_id"] for r in mixed) == Counter({i: n for i, n in copies.items() if n})
    out = corpus_pipeline.run(spark, SF_DIR).collect()
    assert Counter(r["doc_id"] for r in out if r["rank"] == 1) == Counter(r["doc_id"] for r in mixed)
    pieces = piece_sampling.sampler(piece_sampling.model_path(), 1.0).pieces
    assert all(pieces.decode(r["pieces"]) == text[r["doc_id"]] for r in out)


def test_words_counted_together_are_counted_as_one_by_one():
    one, many = (token_counts.PrefixCounter(token_counts.tokenizer_path()) for _ in range(2))
    r = random.Random(9)
    pieces = ["the", "ing", "é", "日本", "x", "a1", "--", "'s", "Ünd", "𐍈", "tion", "q" * 70, "#", "ß", "_", "İ", "é"]
    texts = [" ".join("".join(r.choice(pieces) for _ in range(r.randrange(1, 7))) for _ in range(30)) for _ in range(20)]
    many.meet(texts)
    for text in texts:
        counts = many.prefixes(text)
        assert counts.tolist() == one.prefixes(text).tolist()
        for i in r.sample(range(len(text) + 1), 20):
            assert counts[i] == len(one._library.encode(text[:i], add_special_tokens=False).ids), text[:i]
