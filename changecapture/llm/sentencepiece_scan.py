"""SentencePiece encoding and decoding, giant documents by a parallel max-plus scan.

The vocabulary is a public BPE model; nothing is trained. Its encoding of a text is the only
way to cut the text into pieces such that BPE leaves every two neighbours apart: a shortest
path whose edges weigh 0 (neighbours stay apart) or minus infinity (they would merge), so
parts of a text can be solved on their own, over the states they may begin and end in.

A long document is cut into chunks. The state at a cut is the piece that lies across it (or
ends there) and by how far. Each chunk yields its transfer matrix from states at its left
cut to states at its right cut, in the (max, +) semiring. The matrices of a document are
combined, the states on the best path are read off, and each chunk traces its own pieces
back between its two states. No piece holds a blank inside, so most of a chunk is settled by
the blanks in it, and a matrix only has the few pieces around the cuts.
"""

from __future__ import annotations

import re
import string
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changecapture.llm.common import shards, written

#: Characters of a chunk; shorter documents are encoded in one go.
CHUNK = 65_536
BLANK = "▁"
FRESH = (-2, 0)  # nothing lies across the cut
UNKNOWN = -1
NEVER = 1 << 60
#: Words, and pairs of pieces, that a task remembers: some 150 MB.
REMEMBERED = 600_000
#: Characters that mostly end a word without being part of its last piece.
MARKS = string.punctuation
#: Lengths of the pieces that may begin anywhere.
SHORT = (2, 1)


@dataclass
class Vocabulary:
    pieces: list[str]  # text of each id, "" for bytes and control ids
    ids: dict[str, int]  # piece -> id, of pieces that BPE can produce
    rank: dict[str, int]  # piece -> order in which BPE merges it
    split: dict[str, tuple[str, str]]  # piece -> the two that BPE merges last
    first_byte: int  # id of byte 0
    longest: int
    blanks: list[list[int]] = field(default_factory=list)  # ids of a run of n blanks


def merged(symbols: list[str], rank: dict[str, int]) -> tuple[list[str], tuple[str, str] | None]:
    """Plain BPE: merge the best pair, the leftmost of equals, until none is left."""
    last = None
    while True:
        best, at = NEVER, -1
        for i in range(len(symbols) - 1):
            r = rank.get(symbols[i] + symbols[i + 1], NEVER)
            if r < best:
                best, at = r, i
        if at < 0:
            return symbols, last
        last = (symbols[at], symbols[at + 1])
        symbols = [*symbols[:at], last[0] + last[1], *symbols[at + 2 :]]


def load(model_file: str) -> Vocabulary:
    """Read a BPE model with byte fallback. Only the driver needs the file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    size = model.get_piece_size()
    bytes_ = [i for i in range(size) if model.is_byte(i)]
    special = {i for i in range(size) if model.is_byte(i) or model.is_control(i) or model.is_unknown(i)}
    if len(bytes_) != 256 or bytes_ != list(range(bytes_[0], bytes_[0] + 256)):
        raise ValueError("a model with byte fallback is needed")
    pieces = ["" if i in special else model.id_to_piece(i) for i in range(size)]
    ids = {p: i for i, p in enumerate(pieces) if p}
    scores = sorted({model.get_score(i) for i in ids.values()}, reverse=True)
    order = {score: k for k, score in enumerate(scores)}
    rank = {p: order[model.get_score(i)] for p, i in ids.items()}
    if any(BLANK in p.lstrip(BLANK) or "\n" in p for p in ids):
        raise ValueError("pieces with a blank or line end inside are not supported")
    split = {}
    for piece in list(ids):
        if len(piece) > 1 and piece.strip(BLANK):
            symbols, last = merged(list(piece), rank)
            if len(symbols) > 1:
                del ids[piece]  # BPE never gets there
                continue
            split[piece] = last
            if any(len(p) > 1 and rank[p] >= rank[piece] for p in last):
                raise ValueError(f"not a BPE vocabulary: {piece!r} is merged before its parts")
    longest = max(map(len, ids))
    out = Vocabulary(pieces, ids, rank, split, bytes_[0], longest)
    # runs of blanks all merge at the same rank; they repeat after the longest such piece
    most = max(len(p) for p in ids if not p.strip(BLANK))
    out.blanks = [[ids[p] for p in merged([BLANK] * n, rank)[0]] for n in range(most + 1)]
    return out


class Coder:
    """Encodes texts under a vocabulary; remembers the words it has met."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.apart: dict[str, dict[str, bool]] = {}  # left piece -> right piece -> answer
        self.pairs = 0
        self.lives: dict[tuple[str, int], list] = {}
        # packed ids of the words met lately, and of those met before them
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # lengths of the pieces that may begin a text, by its first five characters if a piece
        # of five or more begins with them, else by its first three; the longest first
        three: dict[str, set[int]] = {}
        five: dict[str, set[int]] = {}
        for piece in vocabulary.ids:
            if len(piece) < 5:
                three.setdefault(piece[:3], set(SHORT)).add(len(piece))
            else:
                five.setdefault(piece[:5], set()).add(len(piece))
        self.three = {k: tuple(sorted(n, reverse=True)) for k, n in three.items()}
        self.five = {
            k: tuple(sorted(n, reverse=True)) + self.three.get(k[:3], SHORT) for k, n in five.items()
        }
        # neighbours that lie together in some piece; nothing is merged across any others
        self.inside = {p[i : i + 2] for p in vocabulary.rank for i in range(len(p) - 1)}
        self.block = re.compile(f"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n")

    # -- neighbours ------------------------------------------------------------------

    def _life(self, piece: str, side: int) -> list[tuple[str, int, int]]:
        """The symbols at one end of a piece while BPE builds it: text, birth, death."""
        out = self.lives.get((piece, side))
        if out is None:
            self.lives[piece, side] = out = []
            death, part = NEVER, piece
            while True:
                parts = self.v.split.get(part)
                birth = self.v.rank[part] if parts else -1
                out.append((part, birth, death))
                if not parts:
                    break
                part, death = parts[side], birth
        return out

    def stay_apart(self, left: str, right: str) -> bool:
        """Whether BPE of ``left + right`` gives these two pieces.

        It does not if two symbols meet at the border, both alive, whose merge comes before
        the end of the left one and not after the end of the right one (of equal merges the
        left comes first).
        """
        known = self.apart.get(left, {}).get(right)
        if known is None:
            known, rank = True, self.v.rank
            lefts, rights = self._life(left, 1), self._life(right, 0)
            for a, born_a, dies_a in lefts:
                for b, born_b, dies_b in rights:
                    if born_a < dies_b and born_b < dies_a:
                        r = rank.get(a + b)
                        if r is not None and r < dies_a and r <= dies_b:
                            known = False
            if self.pairs > REMEMBERED:
                self.apart, self.pairs = {}, 0
            self.apart.setdefault(left, {})[right] = known
            self.pairs += 1
        return known

    def _after(self, text: str, at: int, last: str | None) -> Iterator[str]:
        """Pieces that may follow ``last`` at a position, the longest first."""
        ids = self.v.ids
        bound = last is not None and last in ids
        for n in self.five.get(text[at : at + 5]) or self.three.get(text[at : at + 3], SHORT):
            end = at + n
            if end > len(text):
                continue
            piece = text[at:end]
            if piece in ids:
                if not bound or self.stay_apart(last, piece):
                    yield piece
            elif end == at + 1:
                yield piece  # an unknown character merges with nothing

    def _ids(self, piece: str) -> list[int]:
        known = self.v.ids.get(piece)
        if known is not None:
            return [known]
        return [self.v.first_byte + b for b in piece.encode("utf-8", "surrogatepass")]

    def _blanks(self, n: int) -> list[int]:
        most = len(self.v.blanks) - 1
        return self.v.blanks[most] * (n // most) + self.v.blanks[n % most]

    def _opened(self, run: int, pieces: list[str]) -> list[int]:
        """Ids of a block: blanks before its word, then the pieces of blank and word."""
        if run and pieces and pieces[0] == BLANK:
            return self._blanks(run + 1) + [i for p in pieces[1:] for i in self._ids(p)]
        return self._blanks(run) + [i for p in pieces for i in self._ids(p)]

    # -- paths -----------------------------------------------------------------------

    def path(self, text: str, start: int, last: str | None, stop: int, final=None) -> list[str]:
        """The pieces from a state at ``start`` to the end of ``text``.

        With ``final``, ``(piece, over)``, the path ends in that piece instead, which begins
        before ``stop`` and reaches ``over`` characters beyond.
        """
        pieces, options = [], [self._after(text, start, last)]
        at, dead = start, set()
        while options:
            piece = next(options[-1], None)
            if piece is None:
                options.pop()
                if pieces:
                    piece = pieces.pop()
                    dead.add((at, piece))
                    at -= len(piece)
                continue
            end = at + len(piece)
            if dead and (end, piece) in dead:
                continue
            if final is not None and end >= stop:
                if (piece, end - stop) == final:
                    return [*pieces, piece]
                continue
            pieces.append(piece)
            if final is None and end == len(text):
                return pieces
            at = end
            options.append(self._after(text, at, piece))
        raise ValueError("no path between these states")

    def _pieces(self, text: str) -> list[str]:
        """``path`` of a whole word: the same search, without a generator for each position."""
        ids, three, five, size = self.v.ids, self.three, self.five, len(text)
        out, tried, dead = [], [], set()
        at, last, k, near = 0, None, 0, None
        while True:
            # near: what is known of the pieces after the last one; None if any may follow
            ways, found = five.get(text[at : at + 5]) or three.get(text[at : at + 3], SHORT), False
            while k < len(ways):
                n = ways[k]
                k += 1
                end = at + n
                if end > size:
                    continue
                piece = text[at:end]
                if piece in ids:
                    if near is not None:
                        known = near.get(piece)
                        if not (self.stay_apart(last, piece) if known is None else known):
                            continue
                elif n > 1:
                    continue
                if not dead or (end, piece) not in dead:
                    found = True
                    break
            if found:
                out.append(piece)
                if end == size:
                    return out
                tried.append(k)
                at, last, k = end, piece, 0
                near = self.apart.get(piece, {}) if piece in ids else None
                continue
            piece = out.pop()
            dead.add((at, piece))
            at, k = at - len(piece), tried.pop()
            last = out[-1] if out else None
            near = self.apart.get(last, {}) if last in ids else None

    def _word(self, block: str) -> bytes:
        found = self.words.get(block) or self.older.get(block) or self._split(block)
        if len(self.words) > REMEMBERED // 2:
            self.words, self.older = {}, self.words
        self.words[block] = found
        return found

    def _split(self, block: str) -> bytes:
        """Packed ids of a block not met before: mostly a known word before a mark."""
        at = len(block.rstrip(MARKS))
        if 0 < at < len(block) and block[at - 1] != BLANK and block[at - 1 : at + 1] not in self.inside:
            word, mark = block[:at], block[at:]
            return (self.words.get(word) or self._word(word)) + (self.words.get(mark) or self._word(mark))
        return packed(self._encoded(block))

    def _encoded(self, block: str) -> list[int]:
        core = block.lstrip(BLANK)
        if block == "\n":
            return self._ids("\n")
        if not core:
            return self._blanks(len(block))
        run = len(block) - len(core)
        pieces = self._pieces(BLANK + core if run else core)
        if run < 2:
            try:
                return [self.v.ids[p] for p in pieces]
            except KeyError:
                pass  # an unknown character
        return self._opened(max(run - 1, 0), pieces)

    def blocks(self, marked: str) -> bytes:
        """Packed ids of a stretch that begins and ends where no piece can lie across."""
        words, word = self.words, self._word
        return b"".join([words.get(b) or word(b) for b in self.block.findall(marked)])

    def coded(self, text: str) -> bytes:
        """Packed ids of a whole text."""
        return self.blocks(marked(text)) if text else b""

    def encode(self, text: str) -> list[int]:
        return unpacked(self.coded(text)).tolist()

    def decode(self, ids) -> str:
        shown = [*map(self.v.pieces.__getitem__, ids)]
        if "" not in shown:  # no bytes
            return "".join(shown).replace(BLANK, " ").removeprefix(" ")
        out, pieces, first = [], self.v.pieces, self.v.first_byte
        raw = bytearray()
        for i in ids:
            if first <= i < first + 256:
                raw.append(i - first)
            else:
                if raw:
                    out.append(raw.decode("utf-8", "replace"))
                    raw.clear()
                out.append(pieces[i])
        out.append(raw.decode("utf-8", "replace"))
        return "".join(out).replace(BLANK, " ").removeprefix(" ")

    # -- chunks ----------------------------------------------------------------------

    def states(self, text: str, cut: int) -> list[tuple[str, int]]:
        """Pieces that may lie across a cut or end there, with the part beyond."""
        if cut == 0 or cut == len(text) or free(text, cut):
            return [FRESH]
        out = []
        for start in range(max(0, cut - self.v.longest), cut):
            for end in range(cut, min(len(text), start + self.v.longest) + 1):
                if text[start:end] in self.v.ids or end == start + 1:
                    out.append((text[start:end], end - cut))
        return out

    def _spread(self, text: str, sources: list, stop: int) -> dict:
        """Max-plus products from states at one end of an unbroken stretch to ``stop``."""
        weight: dict[int, dict[str | None, dict]] = {}
        for source, at, last in sources:
            weight.setdefault(at, {}).setdefault(last, {})[source] = 0
        ends: dict[tuple, dict] = {}
        for at in range(min(weight, default=0), stop):
            for last, row in weight.pop(at, {}).items():
                for piece in self._after(text, at, last):
                    end = at + len(piece)
                    into = (
                        weight.setdefault(end, {}).setdefault(piece, {})
                        if end < stop
                        else ends.setdefault((piece, end - stop), {})
                    )
                    for source, w in row.items():
                        into[source] = max(into.get(source, -NEVER), w)
        for at, rows in weight.items():  # states that already lie beyond the stretch
            for last, row in rows.items():
                ends.setdefault((last, at - stop), {}).update(row)
        return ends

    def _frame(self, left: str, body: str, right: str) -> tuple[str, int, int, int, int]:
        """Text, the two cuts, and the first and last free place between them."""
        text = left + body + right
        a, b = len(left), len(left) + len(body)
        places = [i for i in range(a, b + 1) if i in (0, len(text)) or free(text, i)]
        return text, a, b, *((places[0], places[-1]) if places else (-1, -1))

    def transfer(self, left: str, body: str, right: str) -> dict:
        """``(state at the left cut, state at the right cut) -> weight`` of a chunk."""
        text, a, b, first, last = self._frame(left, body, right)
        ins = self.states(text, a) if a else [FRESH]
        sources = [(s, a + s[1], None if s == FRESH else s[0]) for s in ins]
        if first < 0:
            ends = self._spread(text, sources, b)
            return {(s, e): w for e, row in ends.items() for s, w in row.items()}
        heads = {s: 0 for s in ins if s == FRESH and first == a}
        if first > a:
            ends = self._spread(text[:first], sources, first)
            heads = {s: w for (_, over), row in ends.items() if not over for s, w in row.items()}
        if last == b:
            tails = {FRESH: 0}
        else:
            core = self._core(text, last)
            ends = self._spread(text, [(0, core, None)], b)
            tails = {e: row[0] for e, row in ends.items()}
        return {(s, e): v + w for s, v in heads.items() for e, w in tails.items()}

    def _core(self, text: str, at: int) -> int:
        """Where the word of a block begins: at the last of its blanks."""
        while text[at : at + 2] == BLANK * 2:
            at += 1
        return at

    def trace(self, left: str, body: str, right: str, state: tuple, goal: tuple) -> list[int]:
        """Ids of the pieces that begin in a chunk, between two states of the best path."""
        text, a, b, first, last = self._frame(left, body, right)
        before = None if state == FRESH else state[0]
        start = a + state[1]
        if first < 0:
            if start >= b:
                return []
            return [i for p in self.path(text, start, before, b, goal) for i in self._ids(p)]
        out = []
        if start < first:
            head = self.path(text[:first], start, before, first)
            out += [i for p in head for i in self._ids(p)]
        out += unpacked(self.blocks(text[max(first, a) : last])).tolist()
        if last < b:
            core = self._core(text, last)
            out += self._opened(core - last, self.path(text, core, None, b, goal))
        return out


def packed(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


def unpacked(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, np.int32)


def marked(text: str) -> str:
    return BLANK + text.replace(" ", BLANK)


def free(text: str, at: int) -> bool:
    """Whether no piece can lie across a place: before a run of blanks, and around line ends."""
    return (text[at] == BLANK and text[at - 1] != BLANK) or text[at] == "\n" or text[at - 1] == "\n"


def combine(left: dict, right: dict) -> dict:
    """Product of two transfer matrices: the best way over any state between them."""
    rows: dict = {}
    for (middle, end), w in right.items():
        rows.setdefault(middle, []).append((end, w))
    out: dict = {}
    for (start, middle), v in left.items():
        for end, w in rows.get(middle, ()):
            if v + w > out.get((start, end), -NEVER):
                out[start, end] = v + w
    return out


def best_states(matrices: list[dict]) -> list[tuple]:
    """States at all cuts of the best path from the beginning to the end of a document."""
    reached = [{(FRESH, FRESH): 0}]
    for matrix in matrices:
        reached.append(combine(reached[-1], matrix))
    states = [FRESH]
    for k in range(len(matrices) - 1, -1, -1):
        after = states[-1]
        options = {m: w + reached[k][FRESH, m] for (m, e), w in matrices[k].items() if e == after and (FRESH, m) in reached[k]}
        states.append(max(sorted(options), key=options.get))
    return states[::-1]


def chunks(text: str, size: int, context: int) -> list[tuple[str, str, str]]:
    """Left context, body and right context of each chunk; no cut right after a blank."""
    cuts = [0]
    while cuts[-1] < len(text):
        at = min(cuts[-1] + size, len(text))
        while at < len(text) and text[at - 1] == BLANK:
            at += 1
        cuts.append(at)
    return [
        (text[max(0, a - context) : a], text[a:b], text[b : b + context])
        for a, b in zip(cuts[:-1], cuts[1:], strict=True)
    ]


def _lists(values: list[bytes]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(v) // 4 for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(unpacked(b"".join(values))))


def _whole(vocabulary):
    def run(batches):
        coder = Coder(Vocabulary(**vocabulary.value))
        for batch in batches:
            texts = batch.column("_content").to_pylist()
            for start in range(0, len(texts), 1000):
                part = batch.slice(start, 1000)
                ids = _lists([coder.coded(t) for t in texts[start : start + 1000]])
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), part.column("_text"), ids], ["_id", "_text", "ids"]
                )

    return run


def _cut(size: int, context: int):
    def run(batches):
        for batch in batches:
            for row, text in enumerate(batch.column("_content").to_pylist()):
                parts = chunks(marked(text), size, context)
                at = pa.array([row] * len(parts))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id").take(at),
                        batch.column("_text").take(at),
                        pa.array(range(len(parts)), pa.int32()),
                        *(pa.array(column, pa.string()) for column in zip(*parts, strict=True)),
                    ],
                    ["_id", "_text", "no", "left", "body", "right"],
                )

    return run


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[str, str, str]]:
    """Left context, body and right context, one row at a time: bodies are large."""
    columns = [batch.column(c) for c in ("left", "body", "right")]
    for row in range(batch.num_rows):
        yield tuple(c[row].as_py() for c in columns)


def _dump(state: tuple) -> str:
    return f"{state[1]},{'' if state == FRESH else state[0]}"


def _load(state: str) -> tuple:
    over, _, piece = state.partition(",")
    return (piece, int(over)) if piece else FRESH


def _transfers(vocabulary):
    def run(batches):
        coder = Coder(Vocabulary(**vocabulary.value))
        for batch in batches:
            rows = []
            for parts in _parts(batch):
                matrix = coder.transfer(*parts)
                rows.append([(_dump(s), _dump(e), w) for (s, e), w in matrix.items()])
            kind = pa.list_(pa.struct([("s", pa.string()), ("e", pa.string()), ("w", pa.int64())]))
            rows = [[{"s": s, "e": e, "w": w} for s, e, w in r] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("_id", "_text", "no")), pa.array(rows, kind)],
                ["_id", "_text", "no", "matrix"],
            )

    return run


def _scan(rows: pd.DataFrame) -> pd.DataFrame:
    """The states between the chunks of one document."""
    rows = rows.drop_duplicates("no").sort_values("no")
    matrices = [{(_load(c["s"]), _load(c["e"])): c["w"] for c in m} for m in rows["matrix"]]
    states = [_dump(s) for s in best_states(matrices)]
    return rows[["_id", "_text", "no"]].assign(state=states[:-1], goal=states[1:])


def _traced(vocabulary):
    def run(batches):
        coder = Coder(Vocabulary(**vocabulary.value))
        for batch in batches:
            states = batch.column("state").to_pylist(), batch.column("goal").to_pylist()
            ids = [
                packed(coder.trace(*parts, _load(state), _load(goal)))
                for parts, state, goal in zip(_parts(batch), *states, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("_id", "_text", "no")), _lists(ids)],
                ["_id", "_text", "no", "ids"],
            )

    return run


def encode(
    docs: DataFrame,
    vocabulary: Vocabulary,
    chunk: int = CHUNK,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Ids of every whole text: ``doc_id, text_hash, ids``, one row per row of ``docs``.

    The ids are those of the SentencePiece library for the same model: blanks are marked, one
    is put before a text, unknown characters become byte pieces. Null texts are empty texts,
    which have no ids. ``text_hash`` is ``xxhash64`` of the text. Null and repeated ids and repeated rows are kept. Other columns are
    ignored; an empty table gives an empty table.
    """
    if chunk < 1:
        raise ValueError("chunk must be at least 1")
    sent = docs.sparkSession.sparkContext.broadcast(vars(vocabulary))
    text = F.coalesce(F.col(text_column), F.lit(""))
    own = docs.select(F.col(id_column).alias("_id"), F.xxhash64(text).alias("_text"), text.alias("_content"))
    kind = own.schema["_id"].dataType.simpleString()
    whole = own.where(F.length("_content") < chunk).mapInArrow(
        _whole(sent), f"_id {kind}, _text long, ids array<int>"
    )
    long_ = own.where(F.length("_content") >= chunk).select(
        F.to_json(F.struct(F.col("_id").alias("id"))).alias("_id"), "_text", "_content"
    )
    key = "_id string, _text long, no int"
    cut = written(
        long_.mapInArrow(
            _cut(chunk, vocabulary.longest), f"{key}, left string, body string, right string"
        ).repartition(shards(docs), "_id", "_text", "no")
    )
    states = (
        cut.mapInArrow(_transfers(sent), f"{key}, matrix array<struct<s:string,e:string,w:bigint>>")
        # the rows are small and their work is not: deal them out whatever their bytes
        .repartition(shards(docs), "_id", "_text")
        .groupBy("_id", "_text")
        .applyInPandas(_scan, f"{key}, state string, goal string")
    )
    traced = cut.join(written(states), ["_id", "_text", "no"]).mapInArrow(
        _traced(sent), f"{key}, ids array<int>"
    )
    joined = (
        traced.groupBy("_id", "_text")
        .agg(
            F.array_sort(F.collect_set(F.struct("no", "ids"))).alias("parts"),
            F.sum((F.col("no") == 0).cast("int")).alias("copies"),
        )
        .select(
            F.from_json("_id", f"id {kind}")["id"].alias("_id"),
            "_text",
            F.flatten("parts.ids").alias("ids"),
            F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
        )
        .drop("copy")
    )
    renamed = {"_id": "doc_id", "_text": "text_hash"}
    return whole.unionByName(joined).withColumnsRenamed(renamed)


def _texts(vocabulary, kept: list[str]):
    def run(batches):
        coder = Coder(Vocabulary(**vocabulary.value))
        for batch in batches:
            ids = batch.column("ids")
            flat, offsets = ids.flatten().to_numpy(zero_copy_only=False).tolist(), ids.offsets.to_pylist()
            base = offsets[0] if offsets else 0
            texts = [
                coder.decode(flat[a - base : b - base])
                for a, b in zip(offsets[:-1], offsets[1:], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(texts, pa.string())], [*kept, "text"]
            )

    return run


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Adds ``text``, decoded from ``ids``, and drops ``ids``; null ids are no ids.

    Byte pieces that are no UTF-8 become replacement characters, as in the library.
    """
    sent = encoded.sparkSession.sparkContext.broadcast(vars(vocabulary))
    kept = [c for c in encoded.columns if c not in ("ids", "text")]
    own = encoded.select(
        *[F.col(f"`{c}`") for c in kept],
        F.coalesce("ids", F.array().cast("array<int>")).alias("ids"),
    )
    schema = [f"`{c}` {own.schema[c].dataType.simpleString()}" for c in kept]
    return own.mapInArrow(_texts(sent, kept), ", ".join([*schema, "text string"]))
