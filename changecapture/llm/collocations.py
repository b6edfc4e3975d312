"""Phrase collocations: best-first growth of phrases, bounded by the counts of their prefixes.

The score of a phrase is the least of ``1000 * a * n / (l * r)`` over its cuts. As ``a <= r``,
no phrase that begins with ``w`` scores above ``1000 * n / f(w)``: the rarer its first word, the
more it may score. First words are therefore opened from the rarest to the most frequent, in
rounds of a growing share of the text. A language is settled, and not grown any further, once
its last wanted score is above the bound of every first word not opened yet, so that not even a
tie is left. Within a round a phrase grows word by word, while its prefix is frequent enough.

The text is split into words once and kept as blocks of integers with a dictionary. Each round
counts the pairs that begin with its words, and then the windows of up to five words that begin
with a frequent pair. Which words and pairs are frequent reaches the tasks as bitmaps of a fixed
size: a bit set by chance costs work and changes nothing, as all counts are made by phrase.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changecapture.llm.common import discard, written

#: Bits of a bitmap at most (16 MB), bits for each hash below that, and bytes of text in a block.
BITS, EACH, SLICE = 1 << 27, 16, 4 << 20
#: Shares of a language's words that the first words of each round cover at most.
SHARES = (1 / 64, 1 / 8, 1.0)
LONGEST = 5
NO_LANG = "und"

_CUT, _BLANK = b"\xff", b" "
#: A-Z in lower case, tabs as blanks, and all that ends a piece as a byte that UTF-8 has not.
_BYTES = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r",
    b"abcdefghijklmnopqrstuvwxyz " + _CUT * 10,
)
_BLOCK = "lang string, words array<binary>, codes binary, first int, last int, n_words long"


# -- words as blocks of integers ------------------------------------------------------


def tokens(data: bytes) -> pa.DictionaryArray:
    """Words of translated text, and the ends of pieces as words of their own, as a dictionary."""
    raw = np.frombuffer(data, np.uint8)
    kept = raw != _BLANK[0]
    cut = raw == _CUT[0]
    begins = kept.copy()
    begins[1:] &= ~kept[:-1] | cut[:-1] | cut[1:]
    starts = np.flatnonzero(begins[kept])
    values = raw[kept]
    offsets = np.append(starts, len(values)).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(values)]
    return pa.Array.from_buffers(pa.binary(), len(starts), buffers).dictionary_encode()


def slices(data: bytes, size: int):
    """Parts of about ``size`` bytes that end after a word."""
    at = 0
    while at < len(data):
        end = at + size
        if end >= len(data):
            end = len(data)
        else:
            back = max(data.rfind(_BLANK, at, end), data.rfind(_CUT, at, end)) + 1
            if not back:
                ahead = [p for p in (data.find(_BLANK, end), data.find(_CUT, end)) if p >= 0]
                back = min(ahead, default=len(data) - 1) + 1
            end = back
        yield data[at:end], end < len(data)
        at = end


def blocks(data: bytes, size: int):
    """``(words, codes, first, last)`` of translated text, part by part.

    Phrases that start in ``first..last`` belong to the block; the codes around them are there
    to complete these phrases and to tell the word before. A code of -1 ends a piece.
    """
    carried, first = b"", 0
    for part, more in slices(data, size):
        coded = tokens(carried + part)
        words, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        last = max(first, len(codes) - LONGEST) if more else len(codes)
        kept = max(0, last - 1)
        carried = b"".join(w + _BLANK for w in words.take(pa.array(codes[kept:])).to_pylist())
        mark = pc.index(words, _CUT).as_py()
        codes = np.where(codes == mark, -1, codes).astype(np.int32)
        yield words, codes, first, last
        first = last - kept


def _blocks(size: int):
    def run(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            of = langs.indices.to_numpy(zero_copy_only=False)
            for at, lang in enumerate(langs.dictionary.to_pylist()):
                own = batch.column("text").filter(pa.array(of == at)).to_pylist()
                for words, codes, first, last in blocks(_CUT.join(own).translate(_BYTES), size):
                    n = int((codes[first:last] >= 0).sum())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang]),
                            pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words),
                            pa.array([pack.compress(codes.tobytes())], pa.binary()),
                            pa.array([first], pa.int32()),
                            pa.array([last], pa.int32()),
                            pa.array([n], pa.int64()),
                        ],
                        ["lang", "words", "codes", "first", "last", "n_words"],
                    )

    return run


def blocks_of(docs: DataFrame, text_column: str, lang_column: str, size: int = SLICE) -> DataFrame:
    text = F.coalesce(F.col(text_column), F.lit("")).cast("binary")
    lang = F.coalesce(F.col(lang_column).cast("string"), F.lit(NO_LANG))
    return docs.select(lang.alias("lang"), text.alias("text")).mapInArrow(_blocks(size), _BLOCK)


class Block:
    """A block inside a task; codes are padded, so that every phrase may be looked at whole."""

    def __init__(self, batch: pa.RecordBatch, at: int):
        import zstandard

        self.lang = batch.column("lang")[at].as_py()
        self.words = batch.column("words")[at].values.cast(pa.string(), safe=False)
        raw = zstandard.ZstdDecompressor().decompress(batch.column("codes")[at].as_py())
        self.first, self.last = (batch.column(c)[at].as_py() for c in ("first", "last"))
        pad = np.full(LONGEST + 1, -1, np.int64)
        self.codes = np.concatenate([[-1], np.frombuffer(raw, np.int32), pad])

    def at(self, offset: int) -> np.ndarray:
        """Codes at a distance from each start of the block."""
        return self.codes[self.first + 1 + offset : self.last + 1 + offset]

    def hashes(self) -> np.ndarray:
        """Hash of each word in its language, and 0 for what is no word."""
        import xxhash

        seed = xxhash.xxh64_intdigest(self.lang.encode(), seed=42)
        words = self.words.cast(pa.binary()).to_pylist()
        own = [xxhash.xxh64_intdigest(w, seed=seed) for w in words]
        return np.array([*own, 0], np.uint64)

    def phrases(self, columns: list[np.ndarray]) -> pa.Array:
        """Words of each row as text; a code of -1 adds nothing."""
        own = [self.words.take(pa.array(c, mask=c < 0)) for c in columns]
        return pc.binary_join_element_wise(*own, " ", null_handling="skip")

    def rows(self, *arrays, names: list[str]) -> pa.RecordBatch:
        langs = pa.DictionaryArray.from_arrays(
            pa.array(np.zeros(len(arrays[0]), np.int8)), pa.array([self.lang])
        ).cast(pa.string())
        return pa.RecordBatch.from_arrays([langs, *map(pa.array, arrays)], ["lang", *names])


def _each_block(make):
    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                yield from make(Block(batch, at))

    return run


# -- bitmaps of a fixed size ----------------------------------------------------------


def _rolled(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of all but its last word, and of that word."""
    return ((left << np.uint64(13)) | (left >> np.uint64(51))) ^ right


def phrase_hash(lang: Column, phrase: Column) -> Column:
    """The hash that ``_rolled`` builds up inside tasks."""

    def roll(h, word):
        turned = F.shiftleft(h, 13).bitwiseOR(F.shiftrightunsigned(h, 51))
        return turned.bitwiseXOR(F.xxhash64(lang, word))

    words = F.split(phrase, " ")
    return F.aggregate(F.slice(words, 2, LONGEST), F.xxhash64(lang, words[0]), roll)


def bitmap(rows: DataFrame, hashed: Column, most: int = BITS) -> tuple[np.ndarray, int]:
    """Bits set at the hashes of all rows: pages of 4 KB, made by Spark, ``most / 8`` bytes at most."""
    bits = min(most, max(32768, 1 << (EACH * rows.count()).bit_length()))
    value = hashed.bitwiseAND(F.lit(bits - 1)) + 1
    pages = rows.groupBy(F.bitmap_bucket_number(value).alias("page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bits")
    )
    out = np.zeros(max(bits, 32768) // 8, np.uint8)
    for page, own in pages.collect():
        out[(page - 1) * 4096 : page * 4096] = np.frombuffer(own, np.uint8)
    return out, bits


def _set(bitmap, hashes: np.ndarray) -> np.ndarray:
    """Whether the bits of the hashes are set in a bitmap that was sent to the tasks."""
    bits, size = bitmap.value
    at = (hashes & np.uint64(size - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


# -- counts ---------------------------------------------------------------------------


def _words(block: Block):
    own = block.at(0)
    counts = np.bincount(own[own >= 0], minlength=len(block.words))
    met = np.flatnonzero(counts)
    yield block.rows(block.words.take(pa.array(met)), counts[met], names=["phrase", "n"])


def _pairs(opened, frequent):
    """Pairs of an opened and a frequent word."""

    def make(block: Block):
        hashes = block.hashes()
        known = np.arange(len(hashes)) < len(block.words)
        first = _set(opened, hashes) & known
        second = _set(frequent, hashes) & known
        a, b = block.at(0), block.at(1)
        met = first[a] & second[b]
        width = len(block.words) + 1
        pairs, n = np.unique(a[met] * width + b[met], return_counts=True)
        yield block.rows(block.phrases([pairs // width, pairs % width]), n, names=["phrase", "n"])

    return _each_block(make)


def _windows(opened, frequent, unopened, pairs):
    """Words from a frequent pair on, as far as each next pair may be frequent; the word before.

    Pairs that begin with an unopened word have not been counted, and may be frequent.
    """

    def make(block: Block):
        hashes = block.hashes()
        known = np.arange(len(hashes)) < len(block.words)
        starts, often, uncounted = (
            _set(bits, hashes) & known for bits in (opened, frequent, unopened)
        )

        def linked(at: int) -> np.ndarray:
            a, b = block.at(at), block.at(at + 1)
            both = _set(pairs, _rolled(hashes[a], hashes[b]))
            return often[a] & often[b] & (both | uncounted[a])

        links = {at: linked(at) for at in range(-1, LONGEST - 1)}
        pair = _set(pairs, _rolled(hashes[block.at(0)], hashes[block.at(1)]))
        met = np.flatnonzero(starts[block.at(0)] & often[block.at(1)] & pair)
        columns = [np.where(links[-1], block.at(-1), -1)[met], block.at(0)[met], block.at(1)[met]]
        go_on = np.ones(len(met), bool)
        for at in range(1, LONGEST - 1):
            go_on = go_on & links[at][met]
            columns.append(np.where(go_on, block.at(at + 1)[met], -1))
        width = len(block.words) + 2
        keys = [
            ((columns[k] + 1) * width + columns[k + 1] + 1) * width + columns[k + 2] + 1
            for k in range(0, len(columns), 3)
        ]
        order = np.lexsort(keys)
        keys = np.stack(keys)[:, order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
        at = np.flatnonzero(fresh)
        n = np.diff(np.append(at, len(order)))
        columns = [c[order[at]] for c in columns]
        before = block.words.take(pa.array(columns[0], mask=columns[0] < 0))
        yield block.rows(before, block.phrases(columns[1:]), n, names=["before", "phrase", "n"])

    return _each_block(make)


def _lookups(wanted, frequent):
    """Phrases of two to four words whose hash is wanted."""

    def make(block: Block):
        hashes = block.hashes()
        often = _set(frequent, hashes) & (np.arange(len(hashes)) < len(block.words))
        whole, rolled = often[block.at(0)], hashes[block.at(0)]
        width = len(block.words) + 1
        for length in range(2, LONGEST):
            whole = whole & often[block.at(length - 1)]
            rolled = _rolled(rolled, hashes[block.at(length - 1)])
            met = np.flatnonzero(whole & _set(wanted, rolled))
            keys = [block.at(k)[met] for k in range(length)]
            left = keys[0] * width + keys[1]
            right = keys[-2] * width + keys[-1]
            order = np.lexsort([left, right])
            left, right = left[order], right[order]
            fresh = np.ones(len(order), bool)
            fresh[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
            at = np.flatnonzero(fresh)
            n = np.diff(np.append(at, len(order)))
            own = block.phrases([k[order[at]] for k in keys])
            yield block.rows(own, n, names=["phrase", "n"])

    return _each_block(make)


def _summed(blocks: DataFrame, make) -> DataFrame:
    rows = blocks.mapInArrow(make, "lang string, phrase string, n long")
    return rows.groupBy("lang", "phrase").agg(F.sum("n").alias("f"))


def _rounds(words: DataFrame, totals: DataFrame, shares: tuple) -> DataFrame:
    """Number of the round that opens each frequent word.

    Words are put together by the size of their count, a quarter of a doubling at a time, so
    that a language has a few hundred bins at most however many words it has.
    """
    sized = words.withColumn("bin", F.floor(F.log2("f") * 4))
    by_bin = Window.partitionBy("lang").orderBy("bin")
    bins = (
        sized.groupBy("lang", "bin")
        .agg(F.sum("f").alias("own"))
        .withColumn("upto", F.sum("own").over(by_bin))
        .join(totals, "lang")
    )
    later = [F.when(F.col("upto") > F.col("n") * share, 1).otherwise(0) for share in shares[:-1]]
    bins = bins.select("lang", "bin", reduce(Column.__add__, later, F.lit(0)).alias("round"))
    return sized.join(bins, ["lang", "bin"]).drop("bin")


def _phrases(windows: DataFrame, least: int) -> DataFrame:
    """Frequent phrases of two words and more with their counts, and whether a longer one has as many.

    That is so if the word before, or after, is the same at every place: the phrase with that word
    is then as frequent. A phrase inside a longer one with as many has such a neighbour, too.
    """
    words = F.split("phrase", " ")
    grown = (
        windows.groupBy("lang", "before", "phrase")
        .agg(F.sum("n").alias("n"))
        .withColumn("length", F.explode(F.sequence(F.lit(2), F.size(words))))
        .select(
            "lang",
            "before",
            F.array_join(F.slice(words, F.lit(1), F.col("length")), " ").alias("phrase"),
            F.get(words, F.col("length")).alias("after"),
            "length",
            "n",
        )
    )

    def same(side: str) -> Column:
        return (F.count_if(F.col(side).isNull()) == 0) & (F.min(side) == F.max(side))

    return (
        grown.groupBy("lang", "phrase", "length")
        .agg(
            F.sum("n").alias("f"),
            (same("before") | same("after")).alias("always"),
        )
        .where(F.col("f") >= least)
        .select(
            "lang", "phrase", "length", "f",
            (F.coalesce("always", F.lit(False)) & (F.col("length") < LONGEST)).alias("inside"),
        )
    )


def _cuts(phrases: DataFrame) -> DataFrame:
    words = F.split("phrase", " ")
    return (
        phrases.where("not inside")
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("length") - 1)))
        .select(
            "lang", "phrase", F.col("f").alias("a"), "k",
            F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("head"),
            F.array_join(F.slice(words, F.col("k") + 1, F.lit(LONGEST)), " ").alias("rest"),
        )
    )


def _exact(name: str) -> str:
    return f"CAST({name} AS DECIMAL(19, 0))"


def _scored(cuts: DataFrame, counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Each phrase with its lowest-scoring cut; products are decimals of 38 digits."""
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    rests = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    score = F.expr(
        f"({_exact('a')} * {_exact('n')} * 1000BD) div ({_exact('l')} * {_exact('r')})"
    )
    return (
        cuts.join(heads, ["lang", "head"])
        .join(rests, ["lang", "rest"])
        .join(totals, "lang")
        .groupBy("lang", "phrase", "a", "n")
        .agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("least"))
        .select("lang", "phrase", "a", "n", "least.score", "least.l", "least.r")
    )


def _ranked(scored: DataFrame) -> DataFrame:
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    window = Window.partitionBy("lang").orderBy(*order)
    return scored.withColumn("rank", F.row_number().over(window))


def collocations(
    docs: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    least: int = 100,
    top: int = 2000,
    shares: tuple = SHARES,
    size: int = SLICE,
    bits: int = BITS,
) -> DataFrame:
    """The ``top`` phrases of two to five words of each language by score.

    Returns ``lang, rank, phrase, a, l, r, n, score``: ``a`` counts the phrase, ``l`` and ``r`` the
    parts of its lowest-scoring cut, ``n`` all words of the language, and the score is
    ``floor(1000 * a * n / (l * r))``. Phrases occur inside pieces (between ``.,;:!?`` and line ends),
    in any number of documents, ``least`` times or more; those inside a longer one that is as
    frequent are left out. Equal scores rank by ``a``, then by the bytes of the phrase.

    Null texts are empty texts, a null language is ``und``, repeated rows count as often as
    they occur, texts of any length are split where a word ends, and other columns are ignored.
    Tables without a frequent phrase, empty ones too, give no rows.
    """
    if list(shares) != sorted(set(shares)) or shares[-1] != 1:
        raise ValueError("shares must grow, up to 1")
    context = docs.sparkSession.sparkContext
    text = written(blocks_of(docs, text_column, lang_column, size))
    totals = written(text.groupBy("lang").agg(F.sum("n_words").alias("n")))
    frequent = _summed(text, _each_block(_words)).where(F.col("f") >= least)
    frequent = written(frequent.withColumnRenamed("phrase", "word"))
    words = written(_rounds(frequent, totals, shares))
    word_hash = F.xxhash64("lang", "word")
    often = context.broadcast(bitmap(words, word_hash, bits))
    word_counts = words.select("lang", F.col("word").alias("phrase"), "f")

    # languages that are not settled, and what all rounds so far have found
    open_langs, grown, scored = None, [], []
    for step in range(len(shares)):
        left = words if open_langs is None else words.join(open_langs, "lang", "left_semi")
        opened = left.where(F.col("round") == step)
        if opened.isEmpty():
            continue
        own_text = text if open_langs is None else text.join(open_langs, "lang", "left_semi")
        starts = context.broadcast(bitmap(opened, word_hash, bits))
        pairs = written(
            _summed(own_text, _pairs(starts, often)).where(F.col("f") >= least)
        )
        unopened = context.broadcast(bitmap(words.where(F.col("round") > step), word_hash, bits))
        met = pairs.select("lang", "phrase")
        for other in grown:
            met = met.unionByName(other.where("length = 2").select("lang", "phrase"))
        linked = context.broadcast(bitmap(met, phrase_hash(F.col("lang"), F.col("phrase")), bits))
        windows = own_text.mapInArrow(
            _windows(starts, often, unopened, linked),
            "lang string, before string, phrase string, n long",
        )
        # a word whose bit was set by chance belongs to another round
        exact = opened.select("lang", F.col("word").alias("first"))
        phrases = written(
            _phrases(windows, least)
            .withColumn("first", F.substring_index("phrase", " ", 1))
            .join(exact, ["lang", "first"], "left_semi")
            .drop("first")
        )
        discard(pairs)
        for sent in (starts, unopened, linked):
            sent.destroy()
        grown.append(phrases)

        counts = word_counts
        for other in grown:
            counts = counts.unionByName(other.select("lang", "phrase", "f"))
        cuts = _cuts(phrases)
        wanted = written(
            cuts.where(F.col("rest").contains(" "))
            .select("lang", F.col("rest").alias("phrase"))
            .distinct()
            .join(counts, ["lang", "phrase"], "left_anti")
        )
        if not wanted.isEmpty():
            rests = context.broadcast(bitmap(wanted, phrase_hash(F.col("lang"), F.col("phrase")), bits))
            found = _summed(own_text, _lookups(rests, often))
            found = written(found.join(wanted, ["lang", "phrase"], "left_semi"))
            counts = counts.unionByName(found.select("lang", "phrase", "f"))
            rests.destroy()
        scored.append(written(_scored(cuts, counts, totals)))
        if step + 1 == len(shares):
            break

        # no phrase of an unopened word scores above the bound of the rarest one
        so_far = reduce(DataFrame.unionByName, scored)
        last_scores = _ranked(so_far).where(F.col("rank") == top).select("lang", "score")
        bounds = (
            words.where(F.col("round") > step)
            .groupBy("lang")
            .agg(F.min("f").alias("f"))
            .join(totals, "lang")
            .select("lang", F.expr(f"({_exact('n')} * 1000BD) div {_exact('f')}").alias("bound"))
        )
        unsettled = bounds.join(last_scores, "lang", "left").where("score is null or score <= bound")
        if open_langs is not None:
            unsettled = unsettled.join(open_langs, "lang", "left_semi")
        open_langs = written(unsettled.select("lang"))
        if open_langs.isEmpty():
            break

    often.destroy()
    if not scored:
        empty = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"
        return docs.sparkSession.createDataFrame([], empty)
    best = _ranked(reduce(DataFrame.unionByName, scored)).where(F.col("rank") <= top)
    return best.select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
