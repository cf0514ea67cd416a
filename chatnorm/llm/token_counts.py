"""Exact token counts of every prefix of every text, by dynamic programming over prefixes.

A byte-pair encoding of a string ends in exactly one token that can stand after the encoding of what
comes before it. So the last token of each prefix, and with it the count of each prefix, follows from
those of the shorter prefixes; whether two tokens can stand side by side depends on the merge ranks
along their common border alone. Words repeat, so each worker keeps the counts of the white-space
separated chunks and of the words it has met (a bounded number) and only adds them up along a text. The new
words of a slice of texts are counted together: sorted, so that prefixes they share are one, letter by letter
for all of them, with a trie of the vocabulary read from the last letter on for the tokens that a prefix may end in.

Defined results: null and empty texts have no bytes, no tokens and the prefix counts ``[0]``. Repeated
rows give repeated results; a null id is passed on. Other columns of the input are not looked at.
Strings of special tokens inside a text count as the tokenizer counts them by default (one token).
Counts of prefixes are those of the prefix as a text of its own, so they may fall as the prefix grows.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices

#: What a worker remembers at most: chunks, their prefix counts, prefixes of words, pairs of tokens.
CACHED_CHUNKS, CACHED_COUNTS, CACHED_STATES, CACHED_PAIRS = 600_000, 8_000_000, 400_000, 500_000
#: Words of at most so many bytes are counted together, so many at a time.
MOST_LETTERS, WORDS_AT_ONCE = 64, 4096
#: Places for pairs of tokens that a worker remembers, as a power of two.
PAIR_BITS = 20
_SPREAD = np.uint64(0x9E3779B97F4A7C15)

_BLANKS = "\t\n\v\f\r"
_ENDLESS = 1 << 60


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in set(own) else chr(next(rest)) for b in range(256)]


class PrefixCounter:
    """Prefix counts under a byte-level BPE tokenizer file with word-end tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        self._library = Tokenizer.from_file(path)
        ids = model["vocab"]
        self._inner = {k: v for k, v in ids.items() if not k.endswith(suffix)}
        self._final = {k[: -len(suffix)]: v for k, v in ids.items() if k.endswith(suffix)}
        self._longest = max(map(len, ids))
        self._rank: dict[int, dict[int, int]] = {}  # of the merge of two symbols
        self._parts: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            left, right = ids[a], ids[b]
            self._rank.setdefault(left, {})[right] = rank
            self._parts.setdefault(ids[a + b], (left, right, rank))
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self._words = regex.compile(split["pattern"]["Regex"])
        self._special = [t["content"] for t in spec["added_tokens"]]
        self._any_special = regex.compile("|".join(map(regex.escape, self._special)) or r"(?!)")
        self._letters = _byte_letters()
        self._endings = self._by_last_letters()
        self._edges: tuple[dict, dict] = ({}, {})
        self._pairs: dict[int, bool] = {}
        self._slot_pairs, self._slot_fits = np.full(1 << PAIR_BITS, -1, np.int64), np.zeros(1 << PAIR_BITS, bool)
        self._states: dict[str, list[int]] = {}
        self._forget()

    # Two tokens side by side.

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Symbols that stand at an edge of ``token`` while it is merged, each with the rank of the merge that ends it."""
        found = self._edges[side].get(token)
        if found is None:
            found, now, end = [], token, _ENDLESS
            while True:
                found.append((now, end))
                if now not in self._parts:
                    break
                parts = self._parts[now]
                now, end = parts[1 - side], parts[2]
            self._edges[side][token] = found
        return found

    def _side_by_side(self, left: int, right: int) -> bool:
        if len(self._pairs) >= CACHED_PAIRS:
            self._pairs.clear()
        self._pairs[left << 32 | right] = found = self._fits(left, right)
        return found

    def _fits(self, left: int, right: int) -> bool:
        """Whether the encoding of the two strings together is these two tokens: no merge across
        their border comes before the merges that use up its two sides. Of equal merges the left
        one comes first."""
        rights = self._edge(right, 1)
        for a, a_end in self._edge(left, 0):
            if (ranks := self._rank.get(a)) is not None:
                for b, b_end in rights:
                    rank = ranks.get(b)
                    if rank is not None and rank < a_end and rank <= b_end:
                        return False
        return True

    def _word(self, word: str) -> list[int]:
        """Counts of the prefixes of a word (one piece of the tokenizer's split), by character.

        A state holds, of one prefix: the last token of its encoding inside a longer word, the count
        of that encoding, and the count of the prefix as a whole word.
        """
        letters = self._letters
        s = word if word.isascii() and word.isprintable() else "".join([letters[b] for b in word.encode()])
        states, inner, final, pairs, longest = self._states, self._inner, self._final, self._pairs, self._longest
        if len(states) > CACHED_STATES:
            states.clear()
        last, count, out = [0], [0], []
        for i in range(1, len(s) + 1):
            prefix = s[:i]
            state = states.get(prefix) if i <= longest else None
            if state is None:
                state = [0, 0, 0]
                # One last token fits, and mostly a short one.
                for j in range(i - 1, max(0, i - longest) - 1, -1):
                    piece = prefix[j:]
                    token = inner.get(piece)
                    if token is not None and not state[1]:
                        key = last[j] << 32 | token
                        fits = pairs.get(key) if j else True
                        if self._side_by_side(last[j], token) if fits is None else fits:
                            state[0], state[1] = token, count[j] + 1
                    token = final.get(piece)
                    if token is not None and not state[2]:
                        key = last[j] << 32 | token
                        fits = pairs.get(key) if j else True
                        if self._side_by_side(last[j], token) if fits is None else fits:
                            state[2] = count[j] + 1
                    if state[1] and state[2]:
                        break
                if i <= longest:
                    states[prefix] = state
            last.append(state[0])
            count.append(state[1])
            out.append(state[2])
        if len(s) != len(word):
            at, picked = -1, []
            for c in word:
                at += len(c.encode())
                picked.append(out[at])
            out = picked
        return out

    # Chunks without white space.

    def _plain(self, chunk: str) -> list[int] | None:
        """Prefix counts of a chunk without special strings; None if only the library can tell."""
        if chunk.isascii():
            low = chunk.lower()
        else:
            low = "".join(map(str.lower, chunk))
            if len(low) != len(chunk) or not unicodedata.is_normalized("NFC", chunk):
                return None
        if not low.isprintable() and any("\x1c" <= c <= "\x1f" for c in low):
            return None
        out, total, at = [], 0, 0
        for m in self._words.finditer(low):
            out += [total] * (m.start() - at)  # white space other than ASCII
            word = m.group()
            known = self._known_words.get(word)
            known = self._keep(word, self._word(word)) if known is None else known
            start, size, _ = self._entries[known].tolist()
            counts = self._pool[start + 1 : start + size].tolist()
            if word[0] == "'" and len(word) > 1 and word[1].isalpha():
                # What is cut off inside a contraction is split otherwise: ' alone, then letters.
                counts = [1] + [1 + c for c in self._word(word[1:])][:-1] + counts[-1:]
            out += [total + c for c in counts]
            total, at = out[-1], m.end()
        return out + [total] * (len(low) - at)

    def _counted(self, text: str) -> int:
        return len(self._library.encode(text, add_special_tokens=False).ids)

    def chunk(self, chunk: str) -> list[int]:
        """Token counts of the prefixes of 1, 2, ... characters of a chunk without ASCII white space."""
        out: list[int] = []
        base, at = 0, 0
        for m in [*self._any_special.finditer(chunk), None]:
            # Up to its last character, a special string is ordinary text after what stands before it.
            part = chunk[at : m.end() if m else None]
            counts = self._plain(part)
            if counts is None:
                counts = [self._counted(part[: i + 1]) for i in range(len(part))]
            if m:
                before = m.start() - at
                counts[-1] = (counts[before - 1] if before else 0) + 1
                at = m.end()
            out += [base + c for c in counts]
            base = out[-1] if out else 0
        return out

    # Texts.

    def _forget(self) -> None:
        self._ids: dict[str, int] = {}  # of chunks
        self._known_words: dict[str, int] = {}  # of the lower-case pieces of chunks
        self._pool, self._filled = np.zeros(1 << 16, np.int32), 0
        # Of each entry of the pool: where it begins, how long it is, its last count.
        self._entries, self._n = np.zeros((1 << 12, 3), np.int64), 0
        self._pooled([])

    def _pooled(self, counts: list[int] | np.ndarray) -> int:
        end = self._filled + len(counts) + 1
        if end > len(self._pool):
            self._pool = np.concatenate([self._pool, np.zeros(max(len(self._pool), end), np.int32)])
        if self._n == len(self._entries):
            self._entries = np.concatenate([self._entries, np.zeros_like(self._entries)])
        self._pool[self._filled] = 0
        self._pool[self._filled + 1 : end] = counts
        self._entries[self._n] = self._filled, len(counts) + 1, counts[-1] if len(counts) else 0
        self._filled = end
        self._n += 1
        return self._n - 1

    def _keep(self, word: str, counts: list[int] | np.ndarray) -> int:
        self._known_words[word] = found = self._pooled(counts)
        return found

    def _add(self, chunk: str) -> int:
        if chunk.isascii() and chunk.isalpha():  # one word: its counts serve every spelling
            low = chunk.lower()
            found = self._known_words.get(low)
            found = self._keep(low, self._word(low)) if found is None else found
        else:
            found = self._pooled(self.chunk(chunk))
        self._ids[chunk] = found
        return found

    def meet(self, texts: list[str]) -> None:
        """Count the words of texts that are not known yet, all at a time."""
        if len(self._ids) + len(self._known_words) > CACHED_CHUNKS or self._filled > CACHED_COUNTS:
            self._forget()
        new: set[str] = set()
        for text in texts:
            new.update(text.split())
        known, ids, words = self._known_words, self._ids, set()
        for chunk in new:
            if chunk not in ids:
                low = chunk.lower()
                if not (chunk.isascii() and chunk.isalpha()):
                    words.update(self._words.findall(low))
                elif low not in known:
                    words.add(low)
        words = sorted(w.encode() for w in words if w not in known and len(w) <= MOST_LETTERS)
        words = [w for w in words if len(w) <= MOST_LETTERS]
        for start in range(0, len(words), WORDS_AT_ONCE):
            self._meet_words(words[start : start + WORDS_AT_ONCE])

    def _meet_words(self, words: list[bytes]) -> None:
        """Counts of sorted different words of at most ``MOST_LETTERS`` bytes."""
        n, sizes = len(words), np.array([len(w) for w in words])
        longest = int(sizes.max())
        letters = np.frombuffer(b"".join([w.ljust(longest, b"\0") for w in words]), np.uint8).reshape(n, longest)
        differ = np.ones((n, longest), bool)
        differ[1:] = letters[1:] != letters[:-1]
        beyond = np.arange(longest) >= np.minimum(sizes, np.r_[0, sizes[:-1]])[:, None]
        own = np.logical_or.accumulate(differ | beyond, 1)  # whether no word before has the prefix up to here
        last, count, whole = (np.zeros((n, longest + 1), np.int64) for _ in range(3))
        for i in range(1, longest + 1):
            first = np.flatnonzero(own[:, i - 1] & (sizes >= i))
            self._states_at(letters, i, first, last, count, whole)
            source = np.maximum.accumulate(np.where(own[:, i - 1], np.arange(n), 0))
            for states in (last, count, whole):
                states[:, i] = states[source, i]
        # What the pool keeps of a word: 0, and the counts where a character ends.
        places = np.arange(longest + 1)
        goes_on = np.zeros((n, longest + 1), bool)  # a byte that goes on with a character stands behind the prefix
        goes_on[:, :-1] = ((letters & 0xC0) == 0x80) & (places[:-1] < sizes[:, None])
        kept = (places <= sizes[:, None]) & ~goes_on
        self._pool_many([w.decode() for w in words], whole[kept], kept.sum(1), whole[np.arange(n), sizes])

    def _pool_many(self, words: list[str], counts: np.ndarray, sizes: np.ndarray, totals: np.ndarray) -> None:
        n, end = len(words), self._filled + len(counts)
        if end > len(self._pool):
            self._pool = np.concatenate([self._pool, np.zeros(max(len(self._pool), len(counts)), np.int32)])
        if self._n + n > len(self._entries):
            self._entries = np.concatenate([self._entries, np.zeros((max(len(self._entries), n), 3), np.int64)])
        self._pool[self._filled : end] = counts
        self._entries[self._n : self._n + n] = np.stack([self._filled + np.cumsum(sizes) - sizes, sizes, totals], 1)
        self._known_words.update(zip(words, range(self._n, self._n + n), strict=True))
        self._filled, self._n = end, self._n + n

    def _states_at(self, letters, i: int, rows: np.ndarray, last, count, whole) -> None:
        """States of the prefixes of length ``i`` of the words in ``rows``. A last token is looked for from the
        last letter on, as one fits and mostly a short one."""
        keys, following, tokens = self._endings
        node = np.zeros(len(rows), np.int64)
        for at in range(i - 1, -1, -1):
            wanted = node * 256 + letters[rows, at]
            place = np.searchsorted(keys, wanted)
            place[place == len(keys)] = 0
            there = keys[place] == wanted
            rows, node = rows[there], following[place[there]]
            for kind, found in ((0, count), (1, whole)):
                token = tokens[node, kind]
                open_ = np.flatnonzero((token >= 0) & (found[rows, i] == 0))
                if len(open_):
                    r, t = rows[open_], token[open_]
                    if at:
                        fits = self._all_fit(last[r, at] << 32 | t)
                        r, t = r[fits], t[fits]
                    found[r, i] = count[r, at] + 1
                    if not kind:
                        last[r, i] = t
            left = (count[rows, i] == 0) | (whole[rows, i] == 0)
            rows, node = rows[left], node[left]
            if not len(rows):
                return

    def _all_fit(self, pairs: np.ndarray) -> np.ndarray:
        """Whether each pair of tokens fits; a table with one place for each hash remembers what was asked."""
        slot = (pairs.astype(np.uint64) * _SPREAD) >> np.uint64(64 - PAIR_BITS)
        fits = self._slot_fits[slot]
        new = np.flatnonzero(self._slot_pairs[slot] != pairs)
        if len(new):
            asked, back = np.unique(pairs[new], return_inverse=True)
            fits[new] = np.array([self._fits(p >> 32, p & 0xFFFFFFFF) for p in asked.tolist()], bool)[back.reshape(-1)]
            self._slot_pairs[slot[new]] = pairs[new]
            self._slot_fits[slot[new]] = fits[new]
        return fits

    def _by_last_letters(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All tokens by their bytes from the last to the first, as a trie: sorted ``node * 256 + byte``, the nodes
        these lead to, and the token of each node inside a word and at its end (or -1)."""
        byte_of = {letter: b for b, letter in enumerate(self._letters)}
        steps: dict[int, int] = {}
        tokens = [[-1, -1]]
        for kind, pieces in enumerate((self._inner, self._final)):
            for piece, token in pieces.items():
                if any(letter not in byte_of for letter in piece):
                    continue  # a special token
                node = 0
                for letter in reversed(piece):
                    step = node * 256 + byte_of[letter]
                    node = steps.get(step, 0)
                    if not node:
                        node = steps[step] = len(tokens)
                        tokens.append([-1, -1])
                tokens[node][kind] = token
        keys = np.array(sorted(steps), np.int64)
        return keys, np.array([steps[k] for k in keys.tolist()], np.int64), np.array(tokens, np.int64)

    def prefixes(self, text: str) -> np.ndarray:
        """Token counts of the prefixes of 0, 1, ... characters."""
        for blank in _BLANKS:
            text = text.replace(blank, " ")
        known, add = self._ids.get, self._add
        ids = [known(c) or add(c) for c in text.split(" ")]
        start, size, total = self._entries[ids].T
        base = np.cumsum(total) - total
        # Places in the pool: one after the other within a chunk, with a jump between chunks.
        at = np.repeat(start - (np.cumsum(size) - size), size)
        at += np.arange(len(at))
        return self._pool[at] + np.repeat(base.astype(np.int32), size)


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def prefix_tokens(
    df: DataFrame,
    budget: int = 2048,
    path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    every_prefix: bool = True,
) -> DataFrame:
    """``id, n_bytes, n_tokens, kept_chars, prefix_tokens`` of each row.

    ``prefix_tokens[i]`` is the token count of the first i characters, ``n_tokens`` that of all; ``kept_chars`` is
    the length of the longest prefix with at most ``budget`` tokens. Without ``every_prefix`` the list, four
    bytes a character, stays in the worker.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path or tokenizer_path())
        for batch, texts in slices(batches, "t"):
            own.meet(texts)
            found = [own.prefixes(t) for t in texts]
            columns = {
                "i": batch.column(0),
                "n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64()),
                "n_tokens": pa.array([int(f[-1]) for f in found], pa.int64()),
                "kept_chars": pa.array([int(np.flatnonzero(f <= budget)[-1]) for f in found], pa.int64()),
            }
            if every_prefix:
                ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
                columns["prefix_tokens"] = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found), pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    schema = f"i {kind}, n_bytes bigint, n_tokens bigint, kept_chars bigint" + ", prefix_tokens array<int>" * every_prefix
    return (
        df.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
        .mapInArrow(counted, schema)
        .withColumnRenamed("i", id_col)
    )


def tokens_of_prefix(prefix_tokens: Column | str, n_chars: Column | int) -> Column:
    """Token count of the first ``n_chars`` characters (of the whole text, if it is shorter)."""
    column = F.col(prefix_tokens) if isinstance(prefix_tokens, str) else prefix_tokens
    count = F.lit(n_chars) if isinstance(n_chars, int) else n_chars
    return F.element_at(column, F.least(count + 1, F.size(column)).cast("int"))


def op1_token_counts(spark, sf_dir: str) -> DataFrame:
    """Token counts of all documents, from the counts of their prefixes."""
    from .common import table

    counts = prefix_tokens(table(spark, sf_dir, "documents"), every_prefix=False)
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"), "kept_chars")
