"""Sampled segmentations of texts into the pieces of a SentencePiece model, and their decoding.

A text's segmentations are the paths of a lattice, each with the product of the probabilities of its
pieces. The operator draws ``k`` distinct ones without replacement by Gumbel top-k: the k paths whose
log probabilities, each with Gumbel noise added, are largest. The noise is never drawn path by path. A
best-first (A*) search splits the set of all paths step by step into the part that takes the step of the
best path and the rest; the greatest perturbed value of a part is an exact bound, drawn top down (the part
with the best path keeps its parent's value, the rest gets a Gumbel value cut off at it). The search takes
the part with the greatest bound next, so the n-th path it completes is the n-th sample.

Steps of a path are drawn for all words of many texts at a time. A value of the rest behind a prefix
that is too unlikely to win even with the largest noise that 53 random bits can give isn't drawn.
Words repeat, so a worker keeps the lattices it has built (a bounded number). All noise is a hash of the
row key, the sample and the place, so results don't depend on how rows are dealt out.

Piece probabilities: those of the model if it is a unigram model; for BPE models, whose scores are merge
ranks, a Zipf law over the ranks. Characters outside the vocabulary are spelled in byte pieces.

``log_inclusion`` is the log of the probability that the path's perturbed value exceeds the first one that
was not taken (1 if all paths were).

Defined results: null and empty texts have one segmentation, without pieces. A text with fewer than k
segmentations has as many rows as it has. Rows with the same key and text get the same samples; null
keys count as 0. U+2581 in a text can't be told from a blank after decoding, as with the library.
Other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, slices, table

BLANK = "▁"
#: Lattice edges that a worker remembers.
CACHED_EDGES = 1_500_000
#: The largest Gumbel value of a uniform number with 53 bits, and a little more.
MOST_NOISE = 37.5
#: Steps of a path that the search looks at in one go.
BLOCK = 128

#: Latin letters and ASCII characters other than letters are cut apart, unless others stand beside them.
_L, _B = r"A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", r"\x00-@\[-`{-\x7f"
_LETTER, _SIGN = re.compile(f"[{_L}]"), re.compile(f"[{_B}]")
_RUNS = re.compile(rf"{BLANK}*[{_L}]++(?=[{_B}{BLANK}]|\Z)|{BLANK}*[{_B}]++(?=[{_L}{BLANK}]|\Z)|{BLANK}*[^{BLANK}]+|{BLANK}+")
_WHOLE = re.compile(rf"{BLANK}*[^{BLANK}]+|{BLANK}+", re.DOTALL)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def noise(key: np.ndarray, sample: int, place: np.ndarray, use: int) -> np.ndarray:
    """Uniform numbers in (0, 1) that depend on nothing but the arguments."""
    salt = np.uint64((sample * 0x1000193 + use * 0x85EBCA77C2B2AE63 + 0x27D4EB2F165667C5) & (1 << 64) - 1)
    x = mix64((key ^ salt) + place.astype(np.uint64) * _STEP)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


class Pieces:
    """The vocabulary of a model, with log probabilities."""

    def __init__(self, path: str, temperature: float = 1.0):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.strings = [sp.id_to_piece(i) for i in range(n)]
        self.bytes = {int(self.strings[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.unknown = sp.unk_id()
        self.ids = {
            s: i for i, s in enumerate(self.strings) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
        }
        scores = np.array([sp.get_score(i) for i in range(n)])
        own = np.array(sorted(self.ids.values()))
        if scores[own].min() < -1000:  # ranks
            weight = 1.0 / (2.0 - scores)
            rare = 1.0 / (n + 2.0)
        else:
            weight = np.exp(scores)
            rare = float(weight[own].min())
        total = weight[own].sum() + 256 * rare
        self.log = (np.log(weight / total) / temperature).tolist()
        self.log_byte = math.log(rare / total) / temperature
        self.longest = max(map(len, self.ids))
        self._arrow = None
        self.cut = self._cut()

    def _cut(self) -> re.Pattern:
        """How texts are cut into words so that no piece lies across a cut."""
        pieces = [s.lstrip(BLANK) for s in self.ids]
        if any(BLANK in s for s in pieces):
            return re.compile(r".+", re.DOTALL)
        def mixed(a: str, b: str) -> bool:
            return bool(_LETTER.match(a) and _SIGN.match(b) or _SIGN.match(a) and _LETTER.match(b))

        return _WHOLE if any(mixed(*pair) for s in pieces for pair in zip(s, s[1:], strict=False)) else _RUNS

    def normal(self, text: str) -> str:
        return BLANK + text.replace(" ", BLANK) if text else ""

    def spell(self, ids: np.ndarray) -> np.ndarray:
        """Piece numbers with characters outside the vocabulary (negative code points) spelled in bytes."""
        if not len(ids) or ids.min() >= 0:
            return ids
        out: list[int] = []
        for i in ids.tolist():
            out += [i] if i >= 0 else [self.bytes[b] for b in chr(-i).encode("utf-8", "surrogatepass")]
        return np.array(out, np.int32)

    def decode_all(self, lists: pa.ListArray) -> pa.Array:
        """Texts of lists of pieces (null: null)."""
        if self._arrow is None:
            plain = [bytes([self.byte_of[i]]) if i in self.byte_of else x.replace(BLANK, " ").encode() for i, x in enumerate(self.strings)]
            begun = [x.removeprefix(b" ") for x in plain]  # as the first piece of a text
            self._arrow = pa.array(plain + begun, pa.large_binary())
        places = lists.flatten().to_numpy().astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
        places[ends[:-1][np.diff(ends) > 0]] += len(self.strings)
        _, offsets, data = self._arrow.take(pa.array(places)).buffers()
        offsets = np.frombuffer(offsets, np.int64)[ends]
        texts = pa.Array.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(offsets.tobytes()), data])
        try:
            texts = texts.cast(pa.string())
            plainly = not pc.any(pc.match_substring(texts, BLANK)).as_py()
        except pa.ArrowInvalid:  # byte pieces that aren't UTF-8
            plainly = False
        if not plainly:
            return pa.array([None if x is None else self.decode(x) for x in lists.to_pylist()], pa.string())
        return pc.if_else(lists.is_valid(), texts, pa.scalar(None, pa.string()))

    def decode(self, ids: list[int]) -> str:
        strings, spelled = self.strings, self.byte_of
        if spelled.keys().isdisjoint(ids):
            text = "".join([strings[i] for i in ids])
        else:
            out, held = [], bytearray()
            for i in ids:
                if i in spelled:
                    held.append(spelled[i])
                    continue
                if held:
                    out.append(held.decode("utf-8", "replace"))
                    held.clear()
                out.append(strings[i])
            text = "".join(out) + held.decode("utf-8", "replace")
        text = text.replace(BLANK, " ")
        return text[1:] if text.startswith(" ") else text


class Trie:
    """The vocabulary as a trie whose steps are looked up for many places at once."""

    def __init__(self, pieces: Pieces):
        steps: dict[int, int] = {}
        ends = {}
        for string, piece in pieces.ids.items():
            state = 0
            for c in string:
                state = steps.setdefault(state << 21 | ord(c), len(steps) + 1)
            ends[state] = piece
        self.keys = np.array(sorted(steps), np.int64)
        self.next = np.array([steps[k] for k in self.keys.tolist()], np.int64)
        self.ends = np.full(len(steps) + 1, -1, np.int32)
        self.ends[list(ends)] = list(ends.values())
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[self._slot(self.keys)] = True

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * _STEP) >> np.uint64(42)

    def step(self, states: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the states go on with their code point, and to which states."""
        keys = states << 21 | codes
        on = np.flatnonzero(self.maybe[self._slot(keys)])
        keys = keys[on]
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        real = self.keys[at] == keys
        return on[real], self.next[at[real]]


class Words(dict):
    """Numbers of words in the order in which they were first asked for."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = n = len(self)
        return n


class Sampler:
    """Lattices of words and the search. Nodes are places in words, edges pieces that start there."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.trie = pieces, Trie(pieces)
        self.logs = np.array(pieces.log)
        self._forget()

    def _forget(self) -> None:
        self.words = Words()
        self._node, self._size = array("i"), array("i")  # of a word: first node, length
        self._first = array("i")  # of a node: first edge
        self._piece, self._step = array("i"), array("i")  # of an edge
        self._log = array("d")  # its log probability at its node
        self._up_to, self._rest, self._done = array("d"), array("d"), (0, 0)

    def _edges(self, codes: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Place, length, piece and log probability of each edge, by place and from the longest to the shortest;
        ``left`` has the number of characters to the end of the word."""
        pieces = self.pieces
        place, state, length = np.arange(len(codes)), np.zeros(len(codes), np.int64), 0
        found = []
        while len(place):
            on, state = self.trie.step(state, codes[place + length])
            place, length = place[on], length + 1
            piece = self.trie.ends[state]
            hit = piece >= 0
            found.append((place[hit], np.full(int(hit.sum()), length), piece[hit], self.logs[piece[hit]]))
            if length == 1:
                bare = np.ones(len(codes), bool)
                bare[found[0][0]] = False
                bare = np.flatnonzero(bare)
                code = codes[bare]
                n_bytes = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
                if pieces.bytes:
                    spelled = -code
                    spelled[code < 0x80] = [pieces.bytes[c] for c in code[code < 0x80].tolist()]
                else:
                    spelled = np.full(len(code), pieces.unknown)
                found.append((bare, np.ones(len(bare), np.int64), spelled, n_bytes * pieces.log_byte))
            on = left[place] > length
            place, state = place[on], state[on]
        place, length, piece, log = (np.concatenate(c) for c in zip(*found, strict=True))
        order = np.argsort(place * (pieces.longest + 1) - length, kind="stable")
        return place[order], length[order], piece[order], log[order]

    def _build(self) -> None:
        """Lattices of the words that are new, all at a time: at each distance from the ends of the words the log
        of the sum over all paths from there to the end."""
        new, self.words.new = self.words.new, []
        if not new:
            return
        codes = np.frombuffer("".join(new).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        sizes = np.array([len(w) for w in new])
        starts = np.cumsum(sizes) - sizes
        left = np.repeat(starts + sizes, sizes) - np.arange(len(codes))
        place, length, piece, log = self._edges(codes, left)
        counts = np.bincount(place, minlength=len(codes))
        first = np.cumsum(counts) - counts

        nodes = np.argsort(left, kind="stable")
        own = counts[nodes]
        begin = np.cumsum(own) - own
        edges = np.repeat(first[nodes] - begin, own) + np.arange(len(place))
        log_of, to = log[edges], place[edges] + length[edges]
        at_end = left[place[edges]] == length[edges]
        to[at_end] = len(codes)
        ahead = np.zeros(len(codes) + 1)
        node_at = np.concatenate([[0], np.cumsum(np.bincount(left)[1:])])
        edge_at = np.append(begin, len(place))[node_at]
        for d in range(len(node_at) - 1):
            here = slice(node_at[d], node_at[d + 1])
            value = log_of[edge_at[d] : edge_at[d + 1]] + ahead[to[edge_at[d] : edge_at[d + 1]]]
            at = begin[here] - edge_at[d]
            top = np.maximum.reduceat(value, at)
            ahead[nodes[here]] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, own[here])), at))
        end = np.where(left[place] == length, 0.0, ahead[np.minimum(place + length, len(codes))])

        self._node.frombytes((starts + len(self._first)).astype(np.int32).tobytes())
        self._size.frombytes(sizes.astype(np.int32).tobytes())
        self._first.frombytes((first + len(self._piece)).astype(np.int32).tobytes())
        self._piece.frombytes(piece.astype(np.int32).tobytes())
        self._step.frombytes(length.astype(np.int32).tobytes())
        self._log.frombytes((log + end - ahead[place]).tobytes())

    def _summed(self) -> None:
        """For each new edge: the probabilities at its node up to it, and those of the others there."""
        nodes, edges = self._done
        begin = self.first[nodes:].astype(np.int64) - edges
        sizes = np.diff(np.append(begin, len(self.piece) - edges))
        own = np.exp(self.log[edges:])
        sums = np.cumsum(own)
        up_to = sums - np.repeat(np.concatenate([[0.0], sums])[begin], sizes)
        up_to[begin + sizes - 1] = 2.0  # the last edge takes what rounding leaves
        self._up_to.frombytes(up_to.tobytes())
        # Where an edge is nearly certain, the sum of the others is more exact than what it leaves of 1.
        likely = own > 0.5
        rest = np.where(likely, 0.0, 1.0 - own)
        if len(begin):
            rest[likely] = np.repeat(np.add.reduceat(np.where(likely, 0.0, own), begin), sizes)[likely]
        self._rest.frombytes(rest.tobytes())
        self._done = len(self.first), len(self.piece)

    def sample(self, keys: np.ndarray, texts: list[str], k: int) -> list[list[tuple[float, float, np.ndarray]]]:
        """For each text its samples: log probability, perturbed value and pieces; the last entry has the
        bound of the first path that was not taken (or minus infinity) and no pieces."""
        if len(self._piece) > CACHED_EDGES:
            self._forget()
        cut, number = self.pieces.cut, self.words.__getitem__
        place_of: list[int] = []
        counts, lengths = [], []
        for text in texts:
            normal = self.pieces.normal(text)
            own = cut.findall(normal)
            counts.append(len(own))
            lengths.append(len(normal))
            place_of.extend(map(number, own))
        self._build()
        word = np.array(place_of, np.int64)
        view = lambda a, t: np.frombuffer(a, t) if len(a) else np.zeros(0, t)
        self.node, self.size, self.first = (view(a, np.int32) for a in (self._node, self._size, self._first))
        self.piece, self.step = view(self._piece, np.int32), view(self._step, np.int32)
        self.log = view(self._log, np.float64)
        self._summed()
        self.up_to, self.rest = view(self._up_to, np.float64), view(self._rest, np.float64)
        try:
            return self._sampled(keys, word, np.array(counts), np.array(lengths), k)
        finally:
            self.node = self.size = self.first = self.piece = self.step = self.log = self.up_to = self.rest = None

    def _walk(self, key: np.ndarray, sample: int, node: np.ndarray, place: np.ndarray, left: np.ndarray, begin: np.ndarray, edge_at: np.ndarray) -> None:
        """Draw paths from nodes to the ends of their words; ``edge_at`` gets each edge (plus one) at its place."""
        while len(node):
            u = noise(key, sample, place - begin, 0)
            edge = self.first[node].astype(np.int64)
            over = np.flatnonzero(u > self.up_to[edge])
            while len(over):
                edge[over] += 1
                over = over[u[over] > self.up_to[edge[over]]]
            edge_at[place] = edge + 1
            step = self.step[edge]
            on = left > step
            node, place, left = (node + step)[on], (place + step)[on], (left - step)[on]
            key, begin = key[on], begin[on]

    def _sampled(self, keys, word, counts, lengths, k):
        n_texts = len(counts)
        text = np.repeat(np.arange(n_texts), counts)
        size = self.size[word].astype(np.int64)
        place = np.cumsum(size) - size  # in all texts put together
        begin = np.cumsum(lengths) - lengths
        ends = np.concatenate([begin, [int(lengths.sum())]])
        node = self.node[word].astype(np.int64)

        edge_at = np.zeros(ends[-1], np.int64)
        self._walk(keys[text], 0, node, place, size, begin[text], edge_at)
        paths = [edge_at]
        value = (-np.log(-np.log(noise(keys, 0, np.zeros(n_texts, np.int64), 1)))).tolist()
        #: Parts of the search that wait: bound, sample, place, edges taken out there, log probability before it.
        waiting: list[list[tuple[float, int, int, tuple[int, ...], float]]] = [[] for _ in range(n_texts)]
        out: list[list[tuple[float, float, np.ndarray]]] = [[] for _ in range(n_texts)]
        branch: list[tuple[int, tuple[int, ...], float]] = [(int(b), (), 0.0) for b in begin]
        active = range(n_texts)
        for sample in range(k):
            edge_at = paths[sample]
            used = np.flatnonzero(edge_at)
            bounds = np.searchsorted(used, ends)
            edges = edge_at[used] - 1
            logs = self.log[edges]
            starts: list[tuple[int, int, int, int]] = []
            for t in active:
                own = slice(bounds[t], bounds[t + 1])
                out[t].append((float(logs[own].sum()), value[t], self.piece[edges[own]]))
            self._wait(list(active), waiting, keys, sample, used, logs, edges, bounds, branch, value, begin, k)
            for t in active:
                if waiting[t] and sample + 1 < k:
                    value[t], parent, at, taken, before = waiting[t].pop(0)
                    edge = self._another(taken, keys[t], sample + 1, at - int(begin[t]))
                    branch[t] = at, (*taken, edge), before
                    starts.append((t, parent, at, edge))
            active = [t for t, *_ in starts]
            if sample + 1 < k:
                paths.append(self._branched(paths, starts, sample + 1, keys, node, place, size, text, begin))
        for t in range(n_texts):
            out[t].append((0.0, waiting[t][0][0] if waiting[t] else -math.inf, np.zeros(0, np.int32)))
        return out

    def _branched(self, paths, starts, sample, keys, node, place, size, text, begin) -> np.ndarray:
        """Paths that follow their parents to a place, take an edge there, and go on with new draws."""
        edge_at = np.zeros(len(paths[0]), np.int64)
        if not starts:
            return edge_at
        from_word = np.full(len(begin), len(place))
        inner: list[tuple[int, int, int, int]] = []
        for t, parent, at, edge in starts:
            b = int(begin[t])
            edge_at[b:at] = paths[parent][b:at]
            edge_at[at] = edge + 1
            w = int(np.searchsorted(place, at, "right")) - 1
            from_word[t] = w
            gone = at - int(place[w]) + int(self.step[edge])
            if gone < size[w]:
                inner.append((int(node[w]) + gone, int(place[w]) + gone, int(size[w]) - gone, t))
        later = np.flatnonzero(np.arange(len(place)) > from_word[text])
        nodes, places, left, texts = np.array(inner, np.int64).reshape(-1, 4).T
        texts = np.concatenate([texts, text[later]])
        self._walk(
            keys[texts],
            sample,
            np.concatenate([nodes, node[later]]),
            np.concatenate([places, place[later]]),
            np.concatenate([left, size[later]]),
            begin[texts],
            edge_at,
        )
        return edge_at

    def _wait(self, texts, waiting, keys, sample, places, logs, edges, bounds, branch, value, begin, k) -> None:
        """Put the parts beside the new paths into the queues: at each step, all ways but those taken. The steps of a
        path are looked at in blocks, until no later one can win."""
        start = np.searchsorted(places, np.array([branch[t][0] for t in texts], np.int64))
        mass = np.array([branch[t][2] for t in texts], np.float64)
        rows, first = np.array(texts, np.int64), True
        while True:
            on = np.flatnonzero(start < bounds[rows + 1])
            rows, start, mass = rows[on], start[on], mass[on]
            if not len(rows):
                return
            steps = start[:, None] + np.arange(BLOCK)
            inside = steps < bounds[rows + 1][:, None]
            steps = np.minimum(steps, len(places) - 1)
            sums = np.cumsum(np.where(inside, logs[steps], 0.0), axis=1)
            before = mass[:, None] + np.concatenate([np.zeros((len(rows), 1)), sums[:, :-1]], axis=1)
            rest = np.where(inside, self.rest[edges[steps]], 0.0)
            if first:
                for i, t in enumerate(rows.tolist()):
                    if branch[t][1]:
                        rest[i, 0] = sum(math.exp(self.log[e]) for e in self._ways(branch[t][1]))
            u = noise(keys[rows][:, None], sample, places[steps] - begin[rows][:, None], 2)
            with np.errstate(divide="ignore"):
                location = before + np.log(rest)
            bound = -np.logaddexp(-np.array([value[t] for t in rows.tolist()])[:, None], np.log(-np.log(u)) - location)
            best = np.argsort(-bound, axis=1, kind="stable")[:, : k + 1]
            start, mass, on = start + BLOCK, mass + sums[:, -1], np.ones(len(rows), bool)
            for i, t in enumerate(rows.tolist()):
                queue = waiting[t]
                for j in best[i].tolist():
                    if rest[i, j] > 0:
                        gone = branch[t][1] if first and j == 0 and branch[t][1] else (int(edges[steps[i, j]]),)
                        queue.append((float(bound[i, j]), sample, int(places[steps[i, j]]), gone, float(before[i, j])))
                queue.sort(key=lambda w: -w[0])
                del queue[k + 1 :]
                on[i] = len(queue) <= k or mass[i] + MOST_NOISE >= queue[k][0]
            rows, start, mass, first = rows[on], start[on], mass[on], False

    def _ways(self, taken: tuple[int, ...]) -> list[int]:
        """The edges of a node but those taken (at least one)."""
        n = bisect_right(self._first, taken[0])
        end = int(self.first[n]) if n < len(self.first) else len(self.piece)
        return [e for e in range(int(self.first[n - 1]), end) if e not in taken]

    def _another(self, taken: tuple[int, ...], key: np.uint64, sample: int, place: int) -> int:
        """Draw one of the edges that aren't taken, by their probabilities."""
        ways = self._ways(taken)
        sums = np.cumsum(np.exp(self.log[ways] - self.log[ways].max()))
        u = float(noise(np.full(1, key), sample, np.full(1, place), 3)[0])
        return ways[min(int(np.searchsorted(sums, u * sums[-1])), len(ways) - 1)]


@cache
def vocabulary(path: str, temperature: float = 1.0) -> Pieces:
    return Pieces(path, temperature)


@cache
def sampler(path: str, temperature: float) -> Sampler:
    return Sampler(vocabulary(path, temperature))


def log_inclusion(log_prob: float, bound: float) -> float:
    """Log of the probability that a Gumbel value around ``log_prob`` exceeds ``bound``."""
    x = log_prob - bound
    if x < -30:
        return x
    return math.log(-math.expm1(-math.exp(min(x, 700.0))))


def sample_pieces(
    df: DataFrame, k: int = 2, temperature: float = 1.0, path: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, rank, pieces, log_prob, perturbed, log_inclusion`` of the k samples of each row."""
    kind = df.schema[id_col].dataType.simpleString()

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sampler(path or model_path(), float(temperature))
        for batch, texts in slices(batches, "t", 1 << 18):
            keys = mix64(np.array(batch.column(2).to_pylist(), np.int64).view(np.uint64))
            found = own.sample(keys, texts, k)
            rows = np.repeat(np.arange(len(texts)), [len(f) - 1 for f in found])
            pieces = [own.pieces.spell(s[2]) for f in found for s in f[:-1]]
            sizes = np.cumsum([0, *map(len, pieces)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows)),
                    pa.array([r for f in found for r in range(1, len(f))], pa.int32()),
                    pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate(pieces), pa.int32())),
                    pa.array([s[0] for f in found for s in f[:-1]], pa.float64()),
                    pa.array([s[1] for f in found for s in f[:-1]], pa.float64()),
                    pa.array([log_inclusion(s[0], f[-1][1]) for f in found for s in f[:-1]], pa.float64()),
                ],
                ["i", "rank", "pieces", "log_prob", "perturbed", "log_inclusion"],
            )

    schema = f"i {kind}, rank int, pieces array<int>, log_prob double, perturbed double, log_inclusion double"
    key = F.coalesce(F.col(id_col).cast("long"), F.xxhash64(F.col(id_col).cast("string")), F.lit(0).cast("long"))
    named = df.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.when(F.col(id_col).isNull(), 0).otherwise(key).alias("key"))
    return named.mapInArrow(sampled, schema).withColumnRenamed("i", id_col)


def decode_pieces(df: DataFrame, pieces_col: str = "pieces", text_col: str = "decoded", path: str | None = None) -> DataFrame:
    """``df`` with the texts of its pieces in place of them (null: null)."""
    place = df.columns.index(pieces_col)
    others = [c for c in df.columns if c != pieces_col]
    named = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    kept = named.drop(f"c{place}")
    names = [*kept.columns, "text"]

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(path or model_path())
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = own.decode_all(part.column(place))
                columns = [c for i, c in enumerate(part.columns) if i != place]
                yield pa.RecordBatch.from_arrays([*columns, texts], names)

    schema = kept.withColumn("text", F.lit("")).schema
    return named.mapInArrow(decoded, schema).toDF(*others, text_col)


def op10_piece_sampling(spark, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every document, with the digest of what they decode to."""
    samples = sample_pieces(table(spark, sf_dir, "documents"))
    n_pieces = F.size("pieces").alias("n_pieces")
    return decode_pieces(samples.select("doc_id", "rank", n_pieces, "log_prob", "perturbed", "log_inclusion", "pieces")).select(
        "doc_id", "rank", "n_pieces", "log_prob", "perturbed", "log_inclusion", F.sha2("decoded", 256).alias("decoded_sha256")
    )
