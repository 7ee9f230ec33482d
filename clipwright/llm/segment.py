"""SentencePiece encoding and decoding: distinct sampled segmentations by Gumbel top-k over the lattice.

The lattice of a text has a node per character and an edge per piece that stands there; a character without a piece of
its own has one edge, its bytes.  Edge weights come from the vocabulary: -log(1 + rank) x ``sharpness``, rank being the
piece's place in the model's order, so a segmentation's probability is the product of its pieces' weights, normalised.
Sums over completions, from the end of a text to its start, are exact; they make the lattice a process whose steps are
drawn one after another, and they are the heuristic of the search.

The search is a perturbed A* over sets of paths.  The whole lattice has a Gumbel value as its bound.  Following a path
hands the bound to its steps; at every step the siblings not taken are a set with its own, smaller bound, a Gumbel
value truncated at the one above.  The set with the highest bound is always opened next, so segmentations appear in
order of their perturbed scores, each once: a sample without replacement.  The bound left after k of them is the
threshold of the inclusion scores 1 - exp(-exp(log p - threshold)).

Where two neighbouring characters stand side by side in no piece, every segmentation has a border.  Texts are cut there
into units, and a task prepares a distinct unit once (it forgets them when they grow beyond a bound).  Random numbers
come from the row's key alone.

Decoding joins pieces, turns blank marks into blanks and drops the first, which encoding added: any segmentation
decodes to its text.

Defined results: a null or empty text has one segmentation, of no pieces, with score 1; a text with fewer
segmentations than asked for gives all of them, with score 1; repeated rows and null ids give their rows each, equal
keys equal samples; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwright.llm.common import mixed, whole_text

#: Characters of text that are drawn together; a longer text is a block of its own.
BLOCK_CHARS = 400_000
#: Characters of distinct units a task keeps prepared; beyond it starts anew.
KEPT_CHARS = 700_000
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
#: Brings short pieces' fingerprints, which are small, to all places of the table.
_SPREAD = np.uint64(0xD6E8FEB86659FD93)


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Place of a pair of characters in a table; pairs that share one only cost a cut."""
    return (first * np.uint32(0x9E3779B1) ^ second * np.uint32(0x85EBCA77)) >> np.uint32(12)


class Vocabulary:
    """Pieces by fingerprint, their weights, and the bytes for what has no piece."""

    def __init__(self, serialized: bytes, sharpness: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=serialized)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        codes = np.frombuffer("".join(self.pieces[i] for i in plain).encode("utf-32-le"), np.uint32)
        sizes = np.array([len(self.pieces[i]) for i in plain])
        begins = np.cumsum(sizes) - sizes
        place = np.arange(len(codes)) - np.repeat(begins, sizes)
        later = np.flatnonzero(place)
        self.neighbours = np.zeros(1 << 20, bool)
        self.neighbours[_pair(codes[later - 1], codes[later])] = True
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        rank = np.array([-model.get_score(i) for i in plain])
        weight = -np.log1p(np.maximum(rank, 0)) * sharpness
        self.byte_weight = -np.log1p(size) * sharpness
        self.longest = int(sizes.max())
        self.powers = np.multiply.accumulate(np.array([1, *[_BASE] * self.longest], np.uint64))
        keys = np.add.reduceat((codes.astype(np.uint64) + np.uint64(1)) * self.powers[place], begins) * _SPREAD
        order = np.argsort(keys)
        self.keys, self.ids, self.weights = keys[order], np.array(plain, np.int32)[order], weight[order]
        # keys that share their first 20 bits stand side by side: where they begin, and how many there are at most
        slots = (self.keys >> np.uint64(44)).astype(np.int64)
        self.mask = np.zeros(1 << 20, bool)
        self.mask[slots] = True
        self.begin = np.searchsorted(slots, np.arange(1 << 20)).astype(np.int32)
        self.most = int(np.bincount(slots).max())

    def cuts(self, codes: np.ndarray) -> np.ndarray:
        """Whether a border stands before each character but the first (never where a piece may cross)."""
        return ~self.neighbours[_pair(codes[:-1], codes[1:])]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key in the vocabulary, -1 if it is none."""
        out = np.full(len(keys), -1, np.int64)
        keys = keys * _SPREAD
        slots = (keys >> np.uint64(44)).astype(np.int64)
        likely = np.flatnonzero(self.mask[slots])
        at = self.begin[slots[likely]]
        for _ in range(self.most):
            hit = self.keys[at] == keys[likely]
            out[likely[hit]] = at[hit]
            likely, at = likely[~hit], np.minimum(at[~hit] + 1, len(self.keys) - 1)
        return out


@dataclass
class Lattice:
    """The units of a block one after the other; edges by node, longest first, with the probability of each step."""

    first_edge: np.ndarray       # nodes + 1
    length: np.ndarray           # edges: characters
    piece: np.ndarray            # edges: piece id, or -1 - code point for a character's bytes
    log_step: np.ndarray         # edges: log probability of the step at its node
    reach: np.ndarray            # edges: cumulative probability at the node, for drawing; over 1 at the last


def build_lattice(codes: np.ndarray, sizes: np.ndarray, vocabulary: Vocabulary) -> Lattice:
    """The lattice of units that stand one after the other in ``codes``."""
    n = len(codes)
    if not n:
        return Lattice(np.zeros(1, np.int32), np.zeros(0, np.int16), np.zeros(0, np.int32), np.zeros(0), np.zeros(0, np.float32))
    ends = np.repeat(np.cumsum(sizes), sizes)
    left = ends - np.arange(n)                                  # characters to the end of the unit
    # fingerprints of all substrings that may be a piece, by Horner's rule from prefix values
    places, lengths, found = [], [], []
    key = np.zeros(n, np.uint64)
    wide = codes.astype(np.uint64) + np.uint64(1)
    for size in range(1, vocabulary.longest + 1):
        start = np.flatnonzero(left >= size)
        if not len(start):
            break
        key[start] += wide[start + size - 1] * vocabulary.powers[size - 1]
        at = vocabulary.find(key[start])
        hit = at >= 0
        places.append(start[hit])
        lengths.append(np.full(hit.sum(), size, np.int64))
        found.append(at[hit])
        if size == 1:
            lone = start[~hit]
    place, length, at = np.concatenate([*places, lone]), np.concatenate([*lengths, np.ones(len(lone), np.int64)]), np.concatenate(found)
    n_bytes = 1 + (codes[lone] > 0x7F) + (codes[lone] > 0x7FF) + (codes[lone] > 0xFFFF)
    weight = np.concatenate([vocabulary.weights[at], n_bytes * vocabulary.byte_weight])
    piece = np.concatenate([vocabulary.ids[at], -1 - codes[lone].astype(np.int64)])
    order = np.argsort(place * (vocabulary.longest + 1) - length)
    place, length, weight, piece = place[order], length[order], weight[order], piece[order]
    first_edge = np.searchsorted(place, np.arange(n + 1))

    # sums over completions, all units together, from their last characters to their first
    total = np.zeros(n + 1)
    behind = (left.astype(np.uint16) if left.max() < 1 << 16 else left)[place]      # short numbers are sorted by radix
    by_left = np.argsort(behind, kind="stable")
    bounds = np.concatenate([[0], np.cumsum(np.bincount(behind)[1:])])
    log_step = np.zeros(len(place))
    for b, e in zip(bounds[:-1], bounds[1:]):
        own = by_left[b:e]
        if not len(own):
            continue
        node = place[own]
        value = weight[own] + np.where(length[own] == left[node], 0.0, total[np.minimum(node + length[own], n)])
        cut = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        high = np.maximum.reduceat(value, cut)
        repeat = np.diff(np.append(cut, len(own)))
        sums = high + np.log(np.add.reduceat(np.exp(value - np.repeat(high, repeat)), cut))
        total[node[cut]] = sums
        log_step[own] = value - np.repeat(sums, repeat)
    step = np.exp(log_step)
    running = np.cumsum(step)
    before = np.concatenate([[0], running])[first_edge[:-1]]
    reach = (running - before[place]).astype(np.float32)
    reach[first_edge[1:] - 1] = 2.0                       # the last edge of a node takes what rounding left
    return Lattice(first_edge.astype(np.int32), length.astype(np.int16), piece.astype(np.int32), log_step, reach)


class Units:
    """The distinct units that a task has met, as one lattice that grows."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.forget()

    def forget(self) -> None:
        self.prints = np.zeros(0, np.uint64)          # sorted
        self.number = np.zeros(0, np.int64)           # of each print
        self.bounds = np.zeros(1, np.int64)           # nodes before each unit
        self.lattice = build_lattice(np.zeros(0, np.uint32), np.zeros(0, np.int64), self.vocabulary)

    def numbers(self, prints: np.ndarray, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Number of each unit, given sorted fingerprints and where each unit stands in ``codes``."""
        if self.bounds[-1] > KEPT_CHARS:
            self.forget()
        at = np.searchsorted(self.prints, prints)
        held = np.zeros(len(prints), bool)
        inside = at < len(self.prints)
        held[inside] = self.prints[at[inside]] == prints[inside]
        out = np.empty(len(prints), np.int64)
        out[held] = self.number[at[held]]
        new = np.flatnonzero(~held)
        if len(new):
            ends = np.cumsum(sizes[new])
            own = codes[np.repeat(starts[new] - (ends - sizes[new]), sizes[new]) + np.arange(ends[-1])]
            out[new] = len(self.bounds) - 1 + np.arange(len(new))
            self._append(build_lattice(own, sizes[new], self.vocabulary))
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + ends])
            order = np.argsort(np.concatenate([self.prints, prints[new]]), kind="stable")
            self.prints = np.concatenate([self.prints, prints[new]])[order]
            self.number = np.concatenate([self.number, out[new]])[order]
        return out

    def _append(self, more: Lattice) -> None:
        old = self.lattice
        self.lattice = Lattice(
            np.concatenate([old.first_edge, old.first_edge[-1] + more.first_edge[1:]]),
            *(np.concatenate([getattr(old, f), getattr(more, f)]) for f in ("length", "piece", "log_step", "reach")))


def _draw(lattice: Lattice, starts: np.ndarray, stops: np.ndarray, uniform) -> tuple[np.ndarray, np.ndarray]:
    """(edges, unit of each) of paths from each start to its stop, in text order.

    ``uniform`` gives a number from 0 to 1 for each of some units at some nodes.
    """
    edges, units = [], []
    at, active = starts.copy(), np.flatnonzero(starts < stops)
    while len(active):
        node = at[active]
        edge, goal = lattice.first_edge[node], uniform(active, node).astype(np.float32)
        other = np.flatnonzero(lattice.reach[edge] <= goal)       # mostly the first edge is taken
        while len(other):
            edge[other] += 1
            other = other[lattice.reach[edge[other]] <= goal[other]]
        edges.append(edge)
        units.append(active)
        node = node + lattice.length[edge]
        at[active] = node
        active = active[node < stops[active]]
    if not edges:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge, unit = np.concatenate(edges), np.concatenate(units)
    order = np.argsort(unit, kind="stable")
    return edge[order], unit[order]


def _counted(keys: np.ndarray, offsets: np.ndarray):
    """Uniform numbers that depend on a unit's row key, its place in the text and the node alone."""
    base = mixed(keys) + offsets.astype(np.uint64) * np.uint64(_BASE)

    def uniform(units, nodes):
        drawn = mixed(base[units] + nodes.astype(np.uint64) * np.uint64(_BASE))
        return (drawn >> np.uint64(11)).astype(np.float64) * 2.0 ** -53

    return uniform


def _truncated(location: float, bound: float, random) -> float:
    """A Gumbel value with this location, given that it does not exceed the bound; -inf where nothing is left."""
    drawn = random.standard_exponential()
    return -float(np.logaddexp(-bound, np.log(drawn) - location)) if location > -np.inf else -np.inf


def _remaining(log_taken):
    """log(1 - p), -inf where a step has no sibling."""
    with np.errstate(divide="ignore"):
        return np.log(np.maximum(-np.expm1(log_taken), 0.0))


def sample_paths(lattice: Lattice, starts: np.ndarray, first, k: int, random):
    """At most ``k`` distinct paths [(edges, log p, perturbed score)], best first, and the threshold left.

    ``first`` is a drawn path: the one that attains the bound of the whole lattice.  What else is to be drawn is asked
    for: (unit, node) stands for a path from this node of the unit to the end of the last, and (edges, units) is sent.
    """
    bound = -float(np.log(random.standard_exponential()))
    found = []

    def add(edges, words, score, shared):
        """A path whose first ``shared`` steps belong to the sets of the path it left."""
        steps = lattice.log_step[edges]
        before = np.concatenate([[0.0], np.cumsum(steps)])
        # the bounds are Gumbel values truncated at the score; they fall with these numbers, so only the best is worked out
        far = np.full(len(edges), np.inf)
        far[shared:] = np.log(random.standard_exponential(len(edges) - shared)) - (before[shared:-1] + _remaining(steps[shared:]))
        found.append({"edges": edges, "words": words, "before": before, "score": score, "far": far, "taken": {}, "opened": {}})

    def best_set(path):
        """(bound, step) of the set with the highest bound."""
        best = max(((b, t) for t, b in path["opened"].items()), default=(-np.inf, -1))
        if len(path["far"]):
            t = int(np.argmin(path["far"]))
            if path["far"][t] < np.inf:
                best = max(best, (-float(np.logaddexp(-path["score"], path["far"][t])), t))
        return best

    add(*first, bound, 0)
    while True:
        tops = [best_set(p) for p in found]
        best = max(range(len(tops)), key=lambda i: tops[i][0])
        score, t = tops[best]
        if len(found) == k or score == -np.inf:
            return [(p["edges"], float(p["before"][-1]), p["score"]) for p in found], score
        path = found[best]
        edge, word = int(path["edges"][t]), int(path["words"][t])
        begin = int(np.searchsorted(path["words"], word))
        node = int(starts[word]) + int(lattice.length[path["edges"][begin:t]].sum(dtype=np.int64))
        taken = path["taken"].setdefault(t, [edge])
        free = np.array([e for e in range(lattice.first_edge[node], lattice.first_edge[node + 1]) if e not in taken])
        odds = np.exp(lattice.log_step[free] - lattice.log_step[free].max())
        chosen = int(free[min(np.searchsorted(np.cumsum(odds), random.random() * odds.sum(), "right"), len(free) - 1)])
        taken.append(chosen)
        rest = lattice.log_step[free[free != chosen]]
        location = float(path["before"][t] + (np.logaddexp.reduce(rest) if len(rest) else -np.inf))
        path["far"][t], path["opened"][t] = np.inf, _truncated(location, score, random)
        # the new path keeps what stands before the step and draws what follows
        edges, words = yield word, node + int(lattice.length[chosen])
        add(np.concatenate([path["edges"][:t], [chosen], edges]), np.concatenate([path["words"][:t], [word], words]), score, t + 1)


def piece_ids(lattice: Lattice, edges: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Piece ids along a path, bytes for characters that have no piece."""
    pieces = lattice.piece[edges]
    if (pieces >= 0).all():
        return pieces.astype(np.int32)
    out, begin = [], 0
    for at in np.flatnonzero(pieces < 0):
        out.append(pieces[begin:at])
        out.append([vocabulary.bytes[b] for b in chr(-1 - int(pieces[at])).encode("utf-8", "surrogatepass")])
        begin = at + 1
    return np.concatenate([*out, pieces[begin:]]).astype(np.int32)


def _blocks(sizes: list[int]):
    """(first, behind the last) of runs of texts that are drawn together, given their lengths."""
    begin, size = 0, 0
    for i, own in enumerate(sizes):
        if size and size + own > BLOCK_CHARS:
            yield begin, i
            begin, size = i, 0
        size += own
    if sizes:
        yield begin, len(sizes)


def segment_block(texts: list[str], keys: list[int], k: int, seed: int, kept: Units):
    """For each text its [(ids, log p, perturbed score, inclusion score)]."""
    vocabulary = kept.vocabulary
    marked = ["▁" + text.replace(" ", "▁") if text else "" for text in texts]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
    edges = np.concatenate([[0], np.cumsum([len(m) for m in marked], dtype=np.int64)]).astype(np.int64)
    border = np.ones(len(codes) + 1, bool)
    border[1:-1] = vocabulary.cuts(codes) if len(codes) else True
    border[edges] = True
    at = np.flatnonzero(border)
    first = np.searchsorted(at, edges)                        # units before each text
    starts = stops = np.zeros(0, np.int64)
    if len(codes):
        # distinct units by their fingerprints
        power, back = np.full((2, len(codes)), 1, np.uint64)
        power[1:], back[1:] = _BASE, _BACK
        np.multiply.accumulate(power, out=power)
        np.multiply.accumulate(back, out=back)
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * power, out=sums[1:])
        prints = (sums[at[1:]] - sums[at[:-1]]) * back[at[:-1]]
        del sums, power, back
        prints, chosen, units_of = np.unique(prints, return_index=True, return_inverse=True)
        numbers = kept.numbers(prints, codes, at[chosen], np.diff(at)[chosen])
        starts = kept.bounds[numbers][units_of]
        stops = kept.bounds[numbers + 1][units_of]
    lattice = kept.lattice

    # paths of all texts are drawn at once; a unit's numbers depend on its row's key, its place and the round alone
    salted = mixed(np.array([key & (1 << 64) - 1 for key in keys], np.uint64) + np.uint64(seed))
    text_of = np.repeat(np.arange(len(texts)), np.diff(first))
    places = at[:-1][: len(starts)] - edges[text_of] - starts
    path, unit = _draw(lattice, starts, stops, _counted(salted[text_of], places))
    cut = np.searchsorted(unit, first)
    searches, found, asked = [], [[]] * len(texts), []

    def go_on(i, drawn=None):
        try:
            asked.append((i, *searches[i].send(drawn)))
        except StopIteration as end:
            found[i] = end.value

    for i, key in enumerate(keys):
        b, e = first[i], first[i + 1]
        random = np.random.Generator(np.random.Philox(key=[key & (1 << 64) - 1, seed]))
        own = path[cut[i]: cut[i + 1]], unit[cut[i]: cut[i + 1]] - b
        searches.append(sample_paths(lattice, starts[b:e], own, k, random))
        go_on(i)
    while asked:
        salted = salted + np.uint64(_BASE)
        which, word, node = (np.array(x, np.int64) for x in zip(*asked))
        asked.clear()
        begin, end = first[which] + word, first[which + 1]
        upto = np.cumsum(end - begin)
        own = np.repeat(end - upto, end - begin) + np.arange(upto[-1])          # the units from there on, all texts
        from_ = starts[own]
        from_[upto - (end - begin)] = node
        path, unit = _draw(lattice, from_, stops[own], _counted(salted[text_of[own]], places[own]))
        cut = np.searchsorted(unit, np.concatenate([[0], upto]))
        for j, i in enumerate(which.tolist()):
            go_on(i, (path[cut[j]: cut[j + 1]], own[unit[cut[j]: cut[j + 1]]] - first[i]))
    for paths, threshold in found:
        with np.errstate(over="ignore"):
            yield [(piece_ids(lattice, edges_, vocabulary), log_p, score, float(-np.expm1(-np.exp(log_p - threshold))))
                   for edges_, log_p, score in paths]


def encode_samples(docs: DataFrame, model_file: str, k: int = 2, seed: int = 17, sharpness: float = 1.0,
                   id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, sample, pieces, n_pieces, log_prob, perturbed, inclusion): ``k`` segmentations of every document.

    ``pieces`` holds the piece ids as little-endian 32-bit numbers; ``sample`` counts from 1 in order of the
    perturbed scores.
    """
    with open(model_file, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())   # one vocabulary file
    rows = docs.select(F.col(id_column).alias("id"), F.xxhash64(F.col(id_column)).alias("key"), whole_text(text_column).alias("text"))

    def run(batches):
        kept = Units(Vocabulary(shared.value, sharpness))
        for batch in batches:
            sizes = pc.utf8_length(batch.column("text")).to_numpy(zero_copy_only=False)
            for begin, end in _blocks(sizes.tolist()):
                texts = batch.column("text").slice(begin, end - begin).to_pylist()
                keys = batch.column("key").slice(begin, end - begin).to_pylist()
                at, sample, pieces, n, values = [], [], [], [], []
                for i, paths in enumerate(segment_block(texts, keys, k, seed, kept), begin):
                    for number, (ids, *scores) in enumerate(paths, 1):
                        at.append(i)
                        sample.append(number)
                        pieces.append(ids.tobytes())
                        n.append(len(ids))
                        values.append(scores)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(at)), pa.array(sample, pa.int32()), pa.array(pieces, pa.binary()),
                     pa.array(n, pa.int64()), *(pa.array(x, pa.float64()) for x in zip(*values))],
                    names=[id_column, "sample", "pieces", "n_pieces", "log_prob", "perturbed", "inclusion"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_column}` {kind}, sample int, pieces binary, n_pieces long, log_prob double, "
                                "perturbed double, inclusion double")


def decode_samples(samples: DataFrame, model_file: str, pieces_column: str = "pieces", into: str = "text") -> DataFrame:
    """Adds the text that the pieces spell; the empty text for null."""
    with open(model_file, "rb") as file:
        shared = samples.sparkSession.sparkContext.broadcast(file.read())
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in samples.schema.fields)

    def run(batches):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=shared.value)
        size = model.get_piece_size()
        spelled = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else
                   model.id_to_piece(i).replace("▁", " ").encode() for i in range(size)]
        for batch in batches:
            texts = [b"".join([spelled[i] for i in np.frombuffer(raw or b"", np.int32)])[1:].decode("utf-8", "replace")
                     for raw in batch.column(names.index(pieces_column)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*names, into])

    names = samples.columns
    return samples.mapInArrow(run, f"{kept}, `{into}` string")
