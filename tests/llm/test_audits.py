"""Personal data, filter audit and source divergence against plain Python, on small tables with awkward rows."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from chatnorm.llm import filter_audit, private_data, source_divergence

DOCS = "doc_id bigint, text string, lang string, source string, mask int, part string, block int, spans string"
LABELS = "doc_id bigint, quality int, toxic int"


def made(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], DOCS).repartition(3)


# Personal data.

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(figures):
    total = 0
    for i, c in enumerate(reversed(figures)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def passes(kind, found):
    figures = re.sub("[^0-9]", "", found)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(x) <= 255 for x in found.split(".")),
        "card": lambda: 12 <= len(figures) <= 19 and luhn(figures),
        "phone": lambda: 9 <= len(figures) <= 15,
    }[kind]()


def plain_base(text):
    kinds = list(PATTERNS)
    found = [(m.start(), kinds.index(k), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if passes(k, m.group())]
    return [(a, b, kinds[k]) for a, k, b in sorted(found)]


def test_base_spans_are_those_of_the_patterns():
    r = random.Random(1)
    for alphabet in ("a1@.0-+ 29(", "12 -", "a@.", "1.255", "+1 ()-."):
        for _ in range(4000):
            text = "".join(r.choice(alphabet) for _ in range(r.randrange(70)))
            assert [s[:3] for s in private_data.base_spans(text)] == plain_base(text), text


WORDS = {
    "en": "zero one two three four five six seven eight nine".split(),
    "de": "null eins zwei drei vier fünf sechs sieben acht neun".split(),
    "fr": "zéro un deux trois quatre cinq six sept huit neuf".split(),
    "es": "cero uno dos tres cuatro cinco seis siete ocho nueve".split(),
}


@pytest.mark.parametrize(
    "kind, plain, shown",
    [
        ("email", "er.49@mail9.example.com", text)
        for text in (
            "er.49 [at] mail9 [dot] example [dot] com", "er.49(at)mail9(dot)example(dot)com", "er.49 {AT} mail9 <DOT> example.com",
            "er.49 at mail9 dot example dot com", "er.49 @ mail9 . example . com", "er.49&#64;mail9.example.com",
            "er.49 -at- mail9 -dot- example -dot- com", "er.49 *at* mail9 *dot* example.com", "er.49 arroba mail9 punto example punto com",
            "er dot four nine at mail9 dot example dot com", "er.fournine [arobase] mail9 [point] example [point] com",
            "ｅｒ.49＠mail9．example．com", "еr.49@mаil9.ехamplе.соm", "er.4​9@mail9.exam­ple.com", "er.49 at mail9.example.com",
        )
    ]
    + [("ip", "192.168.10.1", t) for t in ("192[.]168[.]10[.]1", "192 dot 168 dot 10 dot 1", "192(dot)168.10 (punkt) 1", "l92.168.1O.1")]
    + [("card", "4111111111111111", t) for t in ("４１１１１１１１１１１１１１１１", "4111 1111‑1111 1111", "4111 1lll 1111 111I", "٤111 1111 1111 1111")]
    + [("card", "4111111111111111", " ".join(w[int(c)] for c in "4111111111111111")) for w in WORDS.values()]
    + [("card", "4111111111111111", t) for t in (
        "4one1one 1one1one 1111 1111", "fouroneoneone oneoneoneone oneoneoneone oneoneoneone", "four,one,one,one,1111,1111,1111".replace(",1", " 1"),
        "four\none\none\none\n111111111111".replace("\n1", " 1"), "4 triple-one 1111 1111 1111",
    )]
    + [("phone", "+14435555793", t) for t in ("+1 (443) 555-５７９３", "plus one four four three 555 5793", "+1 443 five five five-5793", "＋1 443 555 5793")],
)
def test_disguises_are_found_in_place(kind, plain, shown):
    text = f"Écrire là, {shown} , then go on."
    found = [s for s in private_data.private_spans(text) if s[2] == kind]
    covering = [s for s in found if text[s[0] : s[1]] == shown]
    assert covering, found
    assert re.sub("[ ()-]" if kind != "email" else "$^", "", covering[0][4]) == plain


@pytest.mark.parametrize(
    "text",
    [
        "look at example.com for more", "The polka dot at a dot", "un deux trois quatre", "at the. Then dot com", "call one two three",
        "see [1] (at) noon", "bob said. at ten . then", "1 l of 20 l and 3.5 l", "five at six dot", "", "плюс один два",
    ],
)
def test_plain_language_has_no_spans(text):
    assert private_data.private_spans(text) == []


def test_base_spans_stay_and_words_beyond_them_are_left_out():
    text = "bob@example.com dot the +1 (848) 555-1373 Un an"
    assert [(s[2], s[3]) for s in private_data.private_spans(text)] == [("email", True), ("phone", True)]


@pytest.mark.parametrize("unit", ["a", "1", "1.", "one ", "@", "+1 ", " ", "( ", "а", "a@", " dot a", "_at_", "​", "[at]"])
def test_long_texts_take_linear_time(unit):
    private_data.private_spans(unit * (300_000 // len(unit)))


def test_private_data_over_awkward_rows(spark):
    texts = [None, "", "x" * 50, "a@b.cd é 1.2.3.4", "a@b.cd é 1.2.3.4", "a [at] b [dot] cd", "𐍈 a@b.cd " * 3000]
    rows = [(i if i != 4 else None, t, None, None) for i, t in enumerate(texts)]
    docs = made(spark, rows)
    got = {r.doc_id: r for r in private_data.find_private(docs).collect()}
    for i, text, *_ in rows:
        spans = [(s["start"], s["end"], s["kind"], s["base"], s["value"]) for s in got[i].spans]
        assert spans == private_data.private_spans(text or "")
        assert [s[:3] for s in spans if s[3]] == plain_base(text or "")
    assert private_data.find_private(docs.limit(0)).count() == 0
    redacted = {r.doc_id: r for r in private_data.redact(docs).collect()}
    assert redacted[3].text == "[EMAIL] é [IP]" and redacted[5].text == "[EMAIL]" and redacted[0].text is None
    assert redacted[6].text == "𐍈 [EMAIL] " * 3000 and redacted[3].spans == "y"


def test_query_of_private_data(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = private_data.op11_private_data(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_base(texts[r.doc_id] or "")
        numbers = Counter(kind for *_, kind in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(numbers[k] for k in PATTERNS)
        listed = ",".join(f"{k}:{a}:{b}" for a, b, k in base)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))


# Filter audit.


def audited(docs, labels):
    """Every order applied to every document."""
    marks = defaultdict(lambda: [0, 0])
    for i, quality, toxic in labels:
        if i is not None:
            marks[i] = [max(marks[i][0], quality == 1), max(marks[i][1], toxic == 1)]
    least = {}
    for i, text, *_ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    fails, parts = [], {}
    for i, text, lang, _ in docs:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        parts.setdefault(lang or "", []).append(len(fails))
        fails.append(
            {
                f
                for f, bad in (
                    ("A", len(w) < 200),
                    ("B", 100 * len(set(w)) < 50 * len(w)),
                    ("C", 100 * len(re.findall("[A-Z]", text)) > 3 * len(text)),
                    ("D", bool(re.search(r"[#$%&*|]", text))),
                    ("E", i is not None and least[text] < i),
                )
                if bad
            }
        )
    out = {}
    for part, members in parts.items():
        removed = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = set(members)
            for step, f in enumerate(order, 1):
                here = {d for d in left if f in fails[d]}
                gone = set(members) - left
                left -= here
                removed[f] += len(here)
                out[part, order, step] = [
                    len(left), len(here), sum(f in fails[d] for d in gone), sum(fails[d] == {f} for d in members),
                    sum(marks[docs[d][0]][0] for d in here if docs[d][0] is not None),
                    sum(marks[docs[d][0]][1] for d in here if docs[d][0] is not None),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(removed[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def test_filter_audit_against_every_order(spark):
    r = random.Random(4)
    texts = [None, "", " \n", "A b c", "a # b", "word " * 300, " ".join(f"w{i}" for i in range(250)), "ÀÉ" * 40, "X" * 10**5]
    texts += [" ".join(r.choice(["Up", "low", "m$", "n"]) for _ in range(r.randrange(150, 260))) for _ in range(4)]
    docs = [(r.choice([None, *range(40)]), r.choice(texts), r.choice(["en", "de", "", None]), "s") for _ in range(150)]
    docs += [(1, "same", "fr", "s"), (1, "same", "fr", "s"), (1, "same", "en", "s"), (0, "same", "en", None)]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in [*range(0, 40, 2), 2, 2, None]]
    got = filter_audit.audit(made(spark, docs), spark.createDataFrame(labels, LABELS)).collect()
    found = {(x.part, x.filter_order, x.step): tuple(x)[3:] for x in got}
    assert len(got) == len(found) == 600 * 4
    assert found == audited(docs, labels)


def test_filter_audit_of_nothing(spark):
    nothing = made(spark, [(1, "a", "b", "c")]).limit(0)
    assert filter_audit.audit(nothing, spark.createDataFrame([], LABELS)).count() == 0


def test_intervals_cover_each_order_once():
    orders = ["".join(o) for o in itertools.permutations("ABCDE")]
    removal = defaultdict(list)
    for mask, step, low, high in filter_audit.intervals():
        for rank in range(low, high):
            removal[mask, rank].append(step)
    for mask in range(1, 32):
        for rank, order in enumerate(orders):
            first = next(s for s, f in enumerate(order, 1) if mask >> "ABCDE".index(f) & 1)
            assert removal[mask, rank] == [first]


# Source divergence.


def diverged(docs, least=10, top=10):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    seen, counts, groups = Counter(), Counter(), set()
    for _, text, lang, source in docs:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
        seen.update((lang, t) for t in set(terms))
        counts.update((lang, source, t) for t in terms)
    out = set()
    for lang in {g[0] for g in groups}:
        kept = sorted(t for (x, t), n in seen.items() if x == lang and n >= least)
        sources = sorted(s for x, s in groups if x == lang)
        c = {s: [counts[lang, s, t] for t in kept] for s in sources}
        share = lambda row: [1 + 10**9 * (n + 2) // (sum(row) + 2 * len(kept)) for n in row]
        p = {s: share(c[s]) for s in sources}
        q = share([sum(c[s][i] for s in sources) for i in range(len(kept))])
        f = lambda a, b: (a - b) * (a - b) // (a + b)
        for s in sources:
            pairs = sorted((-sum(map(f, p[s], p[o])), o) for o in sources if o != s)
            out |= {(lang, s, "pair", o, -v, rank) for rank, (v, o) in enumerate(pairs, 1)}
            best = sorted((-f(p[s][i], q[i]), t) for i, t in enumerate(kept) if c[s][i] and p[s][i] > q[i])
            out |= {(lang, s, "term", t, -v, rank) for rank, (v, t) in enumerate(best[:top], 1)}
    return out


def corpus(seed, n=300):
    r = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("x", "Ya", "é", "z", "日本") for b in ("", "b", "cc", "ñ", "d")]
    rows = []
    for i in range(n):
        text = r.choice([" ", "\n", ", 1_"]).join(r.choice(vocabulary[: r.randrange(1, 26)]) for _ in range(r.randrange(40)))
        rows.append((i, text, r.choice(["en", "de"]), r.choice(["s0", "s1", "s2", "s10", "é"])))
    rows += [(None, None, None, None), (1, "", "en", None), (2, "word", "fr", "a"), (3, "word", "fr", "b"), (4, "12", "it", "a")]
    return rows + [(5, "same tie", "tie", f"s{i % 2}") for i in range(20)] + [(6, "long " * 300_000 + "É", "de", "s0")]


@pytest.mark.parametrize("block_rows", [7, 50, 200_000])
def test_source_divergence_against_plain_sums(spark, block_rows):
    rows = corpus(block_rows)
    got = source_divergence.divergences(made(spark, rows), block_rows=block_rows).collect()
    found = {(x.lang, x.source, x.part, x.item, x.value, x["rank"]) for x in got}
    assert len(got) == len(found) and found == diverged(rows)


def test_source_divergence_of_nothing_and_passing_on_in_steps(spark, monkeypatch):
    nothing = made(spark, [(1, "a", "b", "c")]).limit(0)
    assert source_divergence.divergences(nothing).count() == 0
    monkeypatch.setattr(source_divergence, "PART_BYTES", 5)
    terms = itertools.chain.from_iterable(source_divergence._terms(("aé, B 日本x\t" * 9).encode()))
    assert list(terms) == [t.encode() for t in ["aé", "b", "日本x"] * 9]


def test_equal_subtrees_are_one_node():
    r = np.random.default_rng(3)
    counts = r.poisson(0.3, (6, 64))
    groups, places = np.nonzero(counts)
    different, leaves = np.unique(counts[groups, places], return_inverse=True)
    levels, roots = source_divergence.consed(groups, places, leaves + 1, 6)
    pairs = {tuple(row[i : i + 2]) for row in counts for i in range(0, 64, 2)}
    assert len(levels[0]) == len(pairs | {(0, 0)})
    assert all(len({tuple(c) for c in level.tolist()}) == len(level) for level in levels)
    p = np.arange(1, len(different) + 2, dtype=np.int64) * 1000
    values = np.r_[0, different]
    for a, b in itertools.combinations(range(6), 2):
        at = [np.searchsorted(values, counts[x]) for x in (a, b)]
        expected = int(source_divergence.price(p[at[0]], p[at[1]]).sum())
        assert source_divergence.compared(levels, roots.get(a, 0), roots.get(b, 0), p, p) == expected


def test_large_counts_stay_exact():
    counts = np.array([0, 1, 10**13], np.int64)
    assert source_divergence.shares(counts, 10**13 + 1, 2).tolist() == [1 + 10**9 * (c + 2) // (10**13 + 5) for c in counts.tolist()]
