"""Inputs that the operators once passed over."""

import random
from collections import Counter

from chatnorm.llm import toxicity


def test_disguises_of_every_form():
    text = "the idiot moron stupid loser clown trash bum scum said word " * 50
    classes = toxicity.letter_classes("\n\n" + text + "\n\n")
    reader = toxicity.Reader(Counter(((classes[:-2] * 28 + classes[1:-1]) * 28 + classes[2:]).tolist()))
    forms = {
        "moron": ["moroon", "m/o/r/o/n", "m,o,r,o,n", "m - o - r - o - n", "mo ron", "m  o  r  o  n", "m\to\tr\to\tn",
                  "m\no\nr\no\nn", "mo\u200bron", "m\u200bo\u200br\u200bo\u200bn", "mo\u00adron"],
        "scum": ["sscum", "sc um"],
        "trash": ["tra5#"],
        "idiot": ["1d107"],
        "bum": ["b u m", "b.u.m"],
    }
    for word, spelled in forms.items():
        for form in spelled:
            assert word in reader.words(f"the {form} said"), form
    assert "gr\u00f6\u00dfe" in reader.words("gr\u00f6\u00df3")


def test_runs_are_decoded_part_by_part_as_a_whole():
    r = random.Random(3)
    text = " ".join("".join(r.choice("abcdeorst") for _ in range(r.randint(1, 6))) for _ in range(400))
    classes = toxicity.letter_classes("\n\n" + text + "\n\n")
    restorer = toxicity.Restorer(Counter(((classes[:-2] * 28 + classes[1:-1]) * 28 + classes[2:]).tolist()))
    for _ in range(300):
        pieces = ["".join(r.choice("abcdeorst0$") for _ in range(r.randint(1, 3))) for _ in range(r.randint(2, 8))]
        span = "".join(p + r.choice((" ", "  ", "-", " - ", "\n")) for p in pieces[:-1]) + pieces[-1]
        assert restorer.restore_run(span) == restorer.restore(span), span


def test_what_is_not_decoded_for_scoring_has_no_mark():
    text = "the idiot moron stupid loser clown trash bum aardvark said wool of a word " * 50
    classes = toxicity.letter_classes("\n\n" + text + "\n\n")
    triples = dict(Counter(((classes[:-2] * 28 + classes[1:-1]) * 28 + classes[2:]).tolist()))
    features = {f: 0.9 for w in ("idiot", "moron", "trash", "aardvark", "wool", "of") for f in toxicity.beginnings(w)}
    scorer = toxicity.Scorer(toxicity.Model(triples, features, 0.01))
    every = toxicity.Scorer(toxicity.Model(triples, features, 0.01))
    every.reader.heads = None
    every._may_have_mark = lambda token: True
    every._of_word = lambda w: max((features.get(f, 0.0) for f in toxicity.beginnings(w)), default=0.0)
    r = random.Random(5)
    spell = [
        lambda w: w, lambda w: " ".join(w), lambda w: "-".join(w), lambda w: "_".join(w), lambda w: w.replace("o", "0").replace("a", "@"),
        lambda w: "".join(c * r.randrange(1, 4) for c in w), lambda w: w[:2] + " " + w[2:4] + "\n" + w[4:], lambda w: w[:2] + "​" + w[2:],
    ]
    words, marked = text.split(), 0
    for _ in range(3000):
        said = " ".join(r.choice(spell)(r.choice(words)) + r.choice(["", ".", "!", "__"]) for _ in range(r.randrange(1, 6)))
        assert scorer.score(said) == every.score(said), said
        marked += scorer.score(said) > 0.5
    assert 500 < marked < 3000


def test_recall_and_precision_on_spelled_words():
    """Marked words in twelve disguises among harmless ones, apart from each other."""
    text = "the idiot moron stupid loser clown trash said word and other texts lie here " * 80
    classes = toxicity.letter_classes("\n\n" + text + "\n\n")
    triples = dict(Counter(((classes[:-2] * 28 + classes[1:-1]) * 28 + classes[2:]).tolist()))
    toxic = ("idiot", "moron", "stupid", "loser", "clown", "trash")
    features = {f: 0.95 for w in toxic for f in (w, "^" + w[:5])}
    scorer = toxicity.Scorer(toxicity.Model(triples, features, 0.01))
    r = random.Random(6)
    harmless = [w for w in text.split() if w not in toxic]
    signs = str.maketrans("oiae", "01@3")
    forms = [lambda w: w.translate(signs), lambda w: " ".join(w), lambda w: ".".join(w), lambda w: w[0] + w[1] * 3 + w[2:], str.upper]
    found = [scorer.score(" ".join(r.choices(harmless, k=30)) + " " + r.choice(forms)(r.choice(toxic))) >= 0.5 for _ in range(300)]
    alarms = [scorer.score(" ".join(r.choice(forms)(w) if r.random() < 0.1 else w for w in r.choices(harmless, k=30))) >= 0.5 for _ in range(300)]
    assert sum(found) >= 0.95 * 300 and sum(alarms) <= 0.02 * 300


def test_a_word_with_one_doubled_letter_is_decoded_as_by_viterbi():
    r = random.Random(7)
    text = " ".join("".join(r.choice(["a", "b", "cc", "d", "ee", "o", "rr", "s", "t", "é"]) for _ in range(r.randint(1, 6))) for _ in range(2000))
    classes = toxicity.letter_classes("\n\n" + text + "\n\n")
    restorer = toxicity.Restorer(Counter(((classes[:-2] * 28 + classes[1:-1]) * 28 + classes[2:]).tolist()))
    shortened = 0
    for _ in range(5000):
        word = "".join(r.choice("abcdeorstéüz") for _ in range(r.randint(1, 8)))
        at = r.randrange(len(word))
        word = word[:at] + word[at] + word[at:]
        expected = restorer.decoded(restorer.columns(word), (0, 0), True)
        assert restorer.restore(word) == expected, word
        shortened += expected != word
    assert 500 < shortened < 4500
