"""Alignment of the tokens of two tokenizers by pointer jumping.

Both tokenizers cut the same bytes. Tokens of one overlap tokens of the other, and the connected
components of these overlaps are the groups between the places where both end a token. Every
token points to the farthest-right token it overlaps; doubling these pointers (each takes over
the pointer of where it points) reaches the last token of the component, which names the group,
in as many steps as the logarithm of the longest chain. All documents of a batch are one line of
bytes, as both tokenizers end a token at the end of each.

A link is a pair of tokens of either side that end together. Links are counted over the whole
corpus by pair; the counts return to the documents by blocks of them, in which each pair is asked
for once.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changecapture.llm.common import written

#: Characters from which a text is encoded in parts, cut where no token can cross.
LONG = 1 << 15
#: Texts that are encoded at a time, and their bytes.
TEXTS, TEXT_BYTES = 1000, 1 << 20
#: Bytes that a worker takes in at a time, of texts and of token lists.
TEXT_BATCH, LIST_BATCH = "4m", "8m"

#: Fixed value: how byte-level BPE cuts a text before merging.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
_BLANK = "▁"
#: Columns of the alignment: tokens of either side, their ids (two bytes each where all ids fit,
#: else four), and a bit for each token that ends a group.
PACKED = {"n_a": "int", "n_b": "int"} | dict.fromkeys(("a_ids", "b_ids", "a_cuts", "b_cuts"), "binary")
SHORT, NUMBER = np.dtype("<u2"), np.dtype("<u4")


# -- tokenizers -----------------------------------------------------------------------


def byte_letters() -> dict[str, int]:
    """Byte that each letter of a byte-level vocabulary stands for.

    Printable bytes are their own Latin-1 letters; the others follow from U+0100 on.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_byte_bpe(path: str) -> dict[bytes, int]:
    """Ids by bytes of a byte-level BPE file without special tokens; read on the driver only."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    letters = byte_letters()
    ids = {bytes(letters[c] for c in entry): i for entry, i in model["vocab"].items() if all(c in letters for c in entry)}
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    order = [model["vocab"][entry] for entry in merged]
    if order != sorted(order) or len(ids) != len(model["vocab"]):
        raise ValueError(f"{path}: ids are not in the order of merges")
    return ids


def load_pieces(path: str) -> bytes:
    """A SentencePiece model as bytes; read on the driver only."""
    with open(path, "rb") as file:
        return file.read()


class Tokenizers:
    """Both tokenizers inside a task, and the bytes of their tokens."""

    def __init__(self, byte_bpe: dict[bytes, int], pieces: bytes):
        import sentencepiece
        import tiktoken

        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=byte_bpe, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        table = [b""] * (max(byte_bpe.values()) + 1)
        for own, i in byte_bpe.items():
            table[i] = own
        self.a_bytes = pa.array(table, pa.binary())
        entries = (self.b.id_to_piece(i) for i in range(self.b.get_piece_size()))
        table = [
            bytes([int(e[3:5], 16)]) if self.b.is_byte(i) else e.replace(_BLANK, " ").encode()
            for i, e in enumerate(entries)
        ]
        self.b_bytes = pa.array(table, pa.binary())

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of a blank and each text, by both tokenizers."""
        a = [self.a.encode_ordinary(" " + t) for t in texts]
        return a, self.b.encode(texts, num_threads=1)


def parts(text: str, size: int) -> list[str]:
    """Parts that join to the text with blanks between, each cut at a blank between other characters.

    Neither tokenizer has a token across such a blank, and both begin the next one with it.
    """
    out, start = [], 0
    while len(text) - start > size:
        at = start + size
        while True:
            at = text.find(" ", at)
            if at < 0 or at + 1 >= len(text):
                return [*out, text[start:]]
            if not text[at - 1].isspace() and not text[at + 1].isspace():
                break
            at += 1
        out.append(text[start:at])
        start = at + 1
    return [*out, text[start:]]


# -- alignment ------------------------------------------------------------------------


def components(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the group of each token, given where the tokens of one line of bytes end.

    Nodes are the tokens of A, then those of B. The farthest-right overlap of a token is the
    token of the other side that holds its last byte, or itself if that ends there, too.
    """
    n = len(a_ends)
    of_a = np.searchsorted(b_ends, a_ends)
    of_b = np.searchsorted(a_ends, b_ends)
    together = b_ends[of_a] == a_ends
    a = np.where(together, np.arange(n), n + of_a)
    # a token of B that ends with one of A points to that
    succ = np.concatenate([a, of_b])
    while True:
        after = succ[succ]
        if np.array_equal(after, succ):
            break
        succ = after
    number = np.cumsum(together) - 1
    return number[succ[:n]], number[succ[n:]]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = np.fromiter((i for own in lists for i in own), np.int32, int(counts.sum()))
    return flat, counts


def _summed(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    ends = np.concatenate([[0], np.cumsum(values)])
    upto = np.cumsum(counts)
    return ends[upto] - ends[upto - counts]


def _joined_bytes(table: pa.Array, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all tokens in a row, and the length of each."""
    return _contents(table.take(pa.array(ids)))


def _contents(own: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.frombuffer(own.buffers()[1], np.int32, len(own) + 1, own.offset * 4)
    data = own.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], np.diff(offsets)


def _packed(values: np.ndarray, counts: np.ndarray, kind: np.dtype = NUMBER) -> pa.BinaryArray:
    """Lists of the given lengths, as bytes."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32) * kind.itemsize
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(values.astype(kind))]
    return pa.Array.from_buffers(pa.binary(), len(counts), buffers)


def _numbers(own: pa.BinaryArray, counts: np.ndarray | None = None) -> np.ndarray:
    """All numbers of a column of packed lists; they are short if the lengths of the lists say so."""
    data, _ = _contents(own)
    short = counts is not None and len(data) == SHORT.itemsize * counts.sum()
    return np.frombuffer(data, SHORT if short else NUMBER).astype(np.int64)


def _places(counts: np.ndarray) -> np.ndarray:
    """Place of each token's bit where every list begins with a new byte."""
    full = (counts + 7) // 8 * 8
    return np.arange(counts.sum()) + np.repeat((np.cumsum(full) - full) - (np.cumsum(counts) - counts), counts)


def _bits(flags: np.ndarray, counts: np.ndarray) -> pa.BinaryArray:
    sizes = (counts + 7) // 8
    bits = np.zeros(int(sizes.sum()) * 8, np.uint8)
    bits[_places(counts)] = flags
    return _packed(np.packbits(bits), sizes, np.dtype("u1"))


def _flags(own: pa.BinaryArray, counts: np.ndarray) -> np.ndarray:
    return np.unpackbits(_contents(own)[0])[_places(counts)].astype(bool)


def _lists(batch: pa.RecordBatch) -> tuple:
    """Ids, lengths, group sizes of either side, and groups of each document, of a whole batch."""
    sides = []
    for side in "ab":
        counts = batch.column(f"n_{side}").to_numpy(zero_copy_only=False).astype(np.int64)
        cuts = _flags(batch.column(f"{side}_cuts"), counts)
        sizes = np.diff(np.flatnonzero(cuts), prepend=-1)
        sides.append((_numbers(batch.column(f"{side}_ids"), counts), counts, sizes))
    return *sides, _summed(cuts, counts)


def align_texts(coder: Tokenizers, texts: list[str], size: int = LONG) -> list[pa.Array]:
    """The ``PACKED`` columns of some texts."""
    own = [parts(t, size) if t else [] for t in texts]
    flat = [p for ps in own for p in ps]
    wanted = [b" " + p.encode() for p in flat]
    lengths = np.fromiter(map(len, wanted), np.int64, len(wanted))
    whole = np.frombuffer(b"".join(wanted), np.uint8)
    of = np.repeat(np.arange(len(texts)), [len(ps) for ps in own])
    right = np.ones(len(texts), bool)
    sides = []
    for table, lists in zip((coder.a_bytes, coder.b_bytes), coder.encode(flat), strict=True):
        ids, counts = _flat(lists)
        data, sized = _joined_bytes(table, ids)
        if not np.array_equal(data, whole):
            made = _summed(sized, counts)
            ends, goal = np.cumsum(made), np.cumsum(lengths)
            for i in range(len(flat)):
                right[of[i]] &= made[i] == lengths[i] and np.array_equal(
                    data[ends[i] - made[i] : ends[i]], whole[goal[i] - lengths[i] : goal[i]]
                )
        sides.append((ids, np.repeat(of, counts), sized))
    # texts that come out otherwise have no tokens
    sides = [[part[right[texts_of]] for part in (ids, texts_of, sized)] for ids, texts_of, sized in sides]
    (a, a_of, a_sized), (b, b_of, b_sized) = sides
    groups = components(np.cumsum(a_sized), np.cumsum(b_sized))
    counts = [np.bincount(own, minlength=len(texts)) for own in (a_of, b_of)]
    kind = SHORT if max(len(coder.a_bytes), len(coder.b_bytes)) <= 1 << 16 else NUMBER
    return [
        *(pa.array(n, pa.int32()) for n in counts),
        *(_packed(ids, n, kind) for ids, n in zip((a, b), counts, strict=True)),
        *(_bits(np.diff(g, append=-1) != 0, n) for g, n in zip(groups, counts, strict=True)),
    ]


def _some(lengths: list[int]):
    """Runs of texts to be encoded together."""
    start, held = 0, 0
    for i, length in enumerate(lengths):
        held += length
        if held >= TEXT_BYTES or i + 1 - start >= TEXTS:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(lengths):
        yield start, len(lengths)


def _aligned(vocabularies, size: int):
    def run(batches):
        coder = Tokenizers(*vocabularies.value)
        for batch in batches:
            content = batch.column("_content")
            for start, end in _some(pc.binary_length(content).to_pylist()):
                texts = content.slice(start, end - start).to_pylist()
                done = align_texts(coder, texts, size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, end - start), *done],
                    ["doc_id", *PACKED],
                )

    return run


def align(
    docs: DataFrame,
    byte_bpe: dict[bytes, int],
    pieces: bytes,
    id_column: str = "doc_id",
    text_column: str = "text",
    size: int = LONG,
) -> DataFrame:
    """Tokens of each text by both tokenizers, and their groups.

    Returns ``doc_id`` and the ``PACKED`` columns, one row per row of ``docs``: the ids of a blank and
    the text by the byte-level BPE (A, ``load_byte_bpe``) and by the SentencePiece model (B,
    ``load_pieces``), and which tokens end a group, that is end where the other side ends a token,
    too. ``unpacked`` makes arrays of them.

    Null and empty texts have no tokens, nor have texts that either side does not reproduce
    byte by byte (B knows no U+2581, and may normalise). Special tokens in a text are plain text.
    Long texts are encoded in parts; a run of ``size`` characters without a blank between other
    characters is one part however long. Repeated rows and null ids are kept, other columns are
    ignored, and an empty table gives an empty table.
    """
    sent = docs.sparkSession.sparkContext.broadcast((byte_bpe, pieces))
    own = docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(text_column, F.lit("")).alias("_content")
    )
    kind = own.schema["doc_id"].dataType.simpleString()
    packed = ", ".join(f"{c} {t}" for c, t in PACKED.items())
    return own.mapInArrow(_aligned(sent, size), f"doc_id {kind}, {packed}")


def _arrays(batches):
    for batch in batches:
        (a, n_a, a_sizes), (b, n_b, b_sizes), n = _lists(batch)
        lists = []
        for values, counts in ((a, n_a), (b, n_b), (a_sizes, n), (b_sizes, n)):
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            own = pa.array(values.astype(np.int32))
            lists.append(pa.ListArray.from_arrays(pa.array(offsets), own))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *lists], ["doc_id", "a_ids", "b_ids", "a_sizes", "b_sizes"]
        )


def unpacked(aligned: DataFrame) -> DataFrame:
    """``align`` as arrays of integers: ids of either side, and its tokens in each group."""
    kind = aligned.schema["doc_id"].dataType.simpleString()
    lists = "a_ids array<int>, b_ids array<int>, a_sizes array<int>, b_sizes array<int>"
    return aligned.select("doc_id", *PACKED).mapInArrow(_arrays, f"doc_id {kind}, {lists}")


# -- links ----------------------------------------------------------------------------

#: Tokens of A in a block of documents, as far as whole documents go.
TOKENS = 500_000


class GroupText:
    """Writes groups as ``a1,a2|b1;a3|b2,b3``."""

    SEPARATORS = (",", "|", ";", "")

    def __init__(self):
        self.known = 0
        self.table = None

    def _grow(self, ids: int) -> None:
        if ids > self.known:
            self.known = max(ids, 1 << 16)
            entries = [f"{i}{s}" for i in range(self.known) for s in self.SEPARATORS]
            self.table = pa.array(entries, pa.binary())

    def __call__(self, a, b, a_sizes, b_sizes, groups) -> list[bytes]:
        """Text of each document; all arguments are those of a batch, one after the other."""
        self._grow(int(max(a.max(initial=0), b.max(initial=0))) + 1)
        a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
        a_at = np.arange(len(a)) + np.repeat(b_ends - b_sizes, a_sizes)
        b_at = np.arange(len(b)) + np.repeat(a_ends, b_sizes)
        codes = np.empty(len(a) + len(b), np.int64)
        codes[a_at], codes[b_at] = a * 4, b * 4
        codes[a_at[a_ends - 1]] += 1
        codes[b_at[b_ends - 1]] += 2
        upto = np.cumsum(groups)
        lasts = b_at[b_ends[upto[groups > 0] - 1] - 1]
        codes[lasts] += 1
        data, sized = _joined_bytes(self.table, codes)
        own = _summed(_summed(sized, a_sizes + b_sizes), groups)
        ends = np.cumsum(own)
        raw = data.tobytes()
        return [raw[e - n : e] for e, n in zip(ends.tolist(), own.tolist(), strict=True)]


def _slices(tokens: np.ndarray, most: int):
    """Runs of documents of about ``most`` tokens."""
    block = np.cumsum(tokens) // most
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(tokens)]
    return [(s, e) for s, e in zip(cuts[:-1], cuts[1:], strict=True) if s < e]


def _linked(most: int):
    import hashlib

    def run(batches):
        import zstandard
        from pyspark import TaskContext

        pack = zstandard.ZstdCompressor(level=1)
        block = TaskContext.get().partitionId() << 32
        write = GroupText()
        for whole in batches:
            tokens = whole.column("n_a").to_numpy(zero_copy_only=False).astype(np.int64)
            for start, end in _slices(tokens, most):
                batch = whole.slice(start, end - start)
                (a, a_counts, a_sizes), (b, b_counts, b_sizes), n = _lists(batch)
                keys = a[np.cumsum(a_sizes) - 1] << 32 | b[np.cumsum(b_sizes) - 1]
                pairs, codes, found = np.unique(keys, return_inverse=True, return_counts=True)
                texts = write(a, b, a_sizes, b_sizes, n)
                digests = [hashlib.sha256(t).hexdigest() if t else "" for t in texts]
                ids = batch.column("doc_id")
                numbers = (a_counts, b_counts, n, pairs >> 32, pairs & 0xFFFFFFFF, found)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block], pa.int64()),
                        pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                        pa.array([digests], pa.list_(pa.string())),
                        *(_packed(own, [len(own)]) for own in numbers),
                        pa.array([pack.compress(codes.astype(NUMBER).tobytes())], pa.binary()),
                    ],
                    ["block", "ids", "digests", *_NUMBERS],
                )
                block += 1

    return run


_NUMBERS = ("n_a", "n_b", "n_groups", "a", "b", "n", "codes")


def _asked(batches):
    """A row for each pair of a block: its place there, and how many links of the block hold it."""
    for batch in batches:
        a, b, n = (_numbers(batch.column(c)) for c in ("a", "b", "n"))
        pairs = pc.binary_length(batch.column("a")).to_numpy(zero_copy_only=False) // NUMBER.itemsize
        block = np.repeat(batch.column("block").to_numpy(zero_copy_only=False), pairs)
        at = np.arange(len(a)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
        rows = [pa.array(own) for own in (block, at, a, b, n)]
        yield pa.RecordBatch.from_arrays(rows, ["block", "at", "a", "b", "n"])


def _answered(blocks: pa.Table, answers: pa.Table) -> pa.Table:
    """Rows of the documents of one block, given the counts of its pairs."""
    import zstandard

    column = lambda name: blocks.column(name).combine_chunks()
    n_a, n_b, n = (_numbers(column(c)) for c in ("n_a", "n_b", "n_groups"))
    raw = zstandard.ZstdDecompressor().decompress(blocks.column("codes")[0].as_py())
    codes = np.frombuffer(raw, NUMBER)
    order = np.argsort(answers.column("at").to_numpy())
    count, best = (answers.column(c).to_numpy()[order][codes] for c in ("count", "best"))
    own = [n_a, n_b, n, n, _summed(best, n), _summed(count, n)]
    return pa.table(
        [column("ids").flatten(), *map(pa.array, own), column("digests").flatten()],
        ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    )


def link_counts(pairs: DataFrame) -> DataFrame:
    """``a, b, count, best``: how many links hold a pair, and whether that is the most of its B id."""
    counts = written(pairs.groupBy("a", "b").agg(F.sum("n").alias("count")))
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    best = (F.col("count") == F.col("most")).cast("long").alias("best")
    return written(counts.join(most, "b").select("a", "b", "count", best))


def link_scores(aligned: DataFrame, most: int = TOKENS) -> DataFrame:
    """Links of each row of ``align`` and how common their pairs are in all rows.

    Returns ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``. A link is a
    pair of tokens that end together, so there is one in each group. ``n_best`` are the links
    whose pair is the most frequent of its B id, ties included; ``count_sum`` sums the counts of
    the links' pairs; the digest is that of the groups as ``a1,a2|b1;a3|b2,b3``, and empty without tokens.
    """
    kind = aligned.schema["doc_id"].dataType.simpleString()
    numbers = ", ".join(f"{c} binary" for c in _NUMBERS)
    blocks = written(
        aligned.mapInArrow(
            _linked(most), f"block long, ids array<{kind}>, digests array<string>, {numbers}"
        ),
        LIST_BATCH,
    )
    pairs = blocks.select("block", "a", "b", "n").mapInArrow(
        _asked, "block long, at long, a long, b long, n long"
    )
    counts = link_counts(pairs)
    answers = pairs.join(counts, ["a", "b"]).select("block", "at", "count", "best")
    out = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long"
    return (
        blocks.drop("a", "b", "n")
        .groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(_answered, f"doc_id {kind}, {out}, groups_sha256 string")
    )
