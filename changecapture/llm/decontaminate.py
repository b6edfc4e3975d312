"""Benchmark decontamination by template windows and slot consistency.

Texts become templates: numbers, names (capitalised inside a sentence) and units (after a
number) are typed placeholders, whose values are kept as slots; a run of names, or of number
words, is one placeholder. Windows of template units
are hash-joined with those of the benchmark, so a re-worded number or name does not hide a
question. A document and an item are then compared along their diagonals: on one, each value
of an item's slots must stand for one value throughout, or the match is an accident of form.
A long passage of an item is enough, whatever share of the item it is.
A second view without names finds copies whose letter case was changed, and a third one, in
which the capital that opens a sentence makes a name too, finds other names in that place.
Items with windows of hardly anything but numbers are also looked for word by word.

The hashes of all benchmark windows are sent to the tasks only while they are few; they drop
the document windows that no item has. Beyond that number all windows go through the join.
With them goes a key of each window, a run of words that it holds and its view does not replace.
A window can only match where its key occurs, so documents without any key are not made into
templates at all.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changecapture.llm.common import doc_key, without, written

WINDOW = 8
#: Tokens of a window that are no placeholders; half of them in a shorter one.
LITERALS = 4
#: Share of an item's windows that a document must hold.
COVERED = 0.5
#: Or units in a row that it must hold: verbatim, or with other values in the slots.
VERBATIM = 13
TEMPLATE = 26
#: Benchmark windows up to which their hashes (8 bytes each) are sent to every task.
SENT = 4_000_000
TOKEN = re.compile(r"\d+(?:[.,:]\d+)*|\w+|[.!?\n,;:()\"“”]")
ENDS = frozenset(".!?\n")
#: Marks that no name or number goes across.
BREAKS = frozenset(",;:()\"“”")
NUMBERS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen "
    "fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy "
    "eighty ninety hundred thousand million billion dozen half".split()
)
SCALES = frozenset("hundred thousand million billion".split())
UNITS = frozenset(
    "mm cm m km in ft yd mi mile miles metre metres meter meters inch inches foot feet yard "
    "yards mg g kg t gram grams kilogram kilograms ounce ounces pound pounds lb lbs ton tons "
    "ml l litre litres liter liters gallon gallons s sec second seconds min minute minutes h "
    "hour hours day days week weeks month months year years cent cents dollar dollars euro "
    "euros percent degrees kmh mph w kw kwh v hz".split()
)
#: Words of a window's key at most.
KEY = 4
LITERAL, NUMBER, UNIT, NAME = 0, 1, 2, 3
#: Views of a text: names inside sentences as placeholders, names as words, every capitalised
#: word as a name, and no placeholders at all.
INNER, WORDS, CAPITALS, EXACT = 0, 1, 2, 3
VIEWS = (INNER, WORDS, CAPITALS, EXACT)
#: Literals that a window narrower than usual must have where every capital is a name.
CAPITAL_LITERALS = 3
END, NUMERAL, MEASURE, CAPITAL, BREAK, SPELLED, AND, SCALE = (1 << i for i in range(8))


def _after(flags: np.ndarray, start: bool = False) -> np.ndarray:
    """Whether the token before has the flag."""
    return np.concatenate([[start], flags[:-1]]) if len(flags) else flags


@dataclass
class View:
    """Units of a text: tokens, or runs of tokens that are one placeholder."""

    tokens: list[str]
    starts: np.ndarray
    merged: np.ndarray  # of each token: part of the unit before
    codes: np.ndarray
    kinds: np.ndarray

    def slots(self, at: int, width: int) -> list[str]:
        """Values of the placeholders of a window, in order, by kind."""
        out = []
        for unit in range(at, at + width):
            if self.kinds[unit] != LITERAL:
                i = j = self.starts[unit]
                while j + 1 < len(self.tokens) and self.merged[j + 1]:
                    j += 1
                out.append(f"{self.kinds[unit]}{' '.join(self.tokens[i : j + 1]).lower()}")
        return out


class Templates:
    """Units of a text with kinds, codes and values, by view."""

    def __init__(self, window: int, literals: int):
        self.window, self.literals = window, literals
        self.known: dict[str, tuple[int, int]] = {}

    def _learn(self, token: str) -> tuple[int, int]:
        """Code of a token's lower case, and flags."""
        lower = token.lower()
        code = xxhash.xxh3_64_intdigest(lower)
        flags = (
            (token in ENDS) * END
            | (token[0].isdigit() or lower in NUMBERS) * NUMERAL
            | (lower in UNITS) * MEASURE
            | token[0].isupper() * CAPITAL
            | (token in BREAKS) * BREAK
            | (lower in NUMBERS) * SPELLED
            | (lower == "and") * AND
            | (lower in SCALES) * SCALE
        )
        if len(self.known) > 100_000:
            self.known.clear()
        self.known[token] = code, flags
        return code, flags

    def __call__(self, text: str, views) -> dict[int, View]:
        """Units of the text in each of the views."""
        known, learn = self.known, self._learn
        tokens = TOKEN.findall(text)
        pairs = [known.get(t) or learn(t) for t in tokens]
        codes = np.array([p[0] for p in pairs], np.uint64)
        flags = np.array([p[1] for p in pairs], np.uint8)
        has = lambda flag: (flags & flag) > 0
        apart = has(BREAK)
        adjacent, flags, codes = _after(~apart)[~apart], flags[~apart], codes[~apart]
        tokens = [t for t, a in zip(tokens, apart.tolist(), strict=True) if not a]
        end, number, spelled = has(END), has(NUMERAL), has(SPELLED)
        first = _after(end, True)
        # "one hundred and five"
        link = has(AND) & adjacent & _after(has(SCALE))
        link &= np.concatenate([(spelled & adjacent)[1:], [False]]) if len(link) else link
        number |= link
        unit = has(MEASURE) & _after(number)
        plain = np.select([number, unit], [NUMBER, UNIT], LITERAL)
        run = adjacent & (link | (spelled & _after(number)))
        capital = has(CAPITAL) & (plain == LITERAL)
        out = {}
        for view in views:
            kinds, merged = plain, run
            if view == EXACT:
                kinds, merged = np.zeros_like(plain), np.zeros_like(run)
            elif view in (INNER, CAPITALS):
                name = capital & ~first if view == INNER else capital
                kinds = np.where(name, NAME, plain)
                merged = run | (name & adjacent & _after(name))
            starts = np.flatnonzero(~end & ~merged)
            out[view] = View(tokens, starts, merged, codes[starts], kinds[starts])
        return out

    def windows(self, of: View, view: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of the windows with enough literal units."""
        codes, kinds = of.codes, of.kinds
        n = max(0, len(codes) - width + 1) if width else 0
        symbols = np.where(kinds == LITERAL, codes, kinds.astype(np.uint64))
        h = np.full(n, np.uint64(width * len(VIEWS) + view))
        for i in range(width):
            h = (h ^ symbols[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(31)
        literal = np.concatenate([[0], np.cumsum(kinds == LITERAL)])
        least = max((width + 1) // 2, CAPITAL_LITERALS if view == CAPITALS else 0)
        at = np.flatnonzero(literal[width : width + n] - literal[:n] >= min(self.literals, least))
        return at, h[at].view(np.int64)

    def asked(self, text: str) -> list[tuple[int, int, View, np.ndarray, np.ndarray]]:
        """View, width, units, positions and hashes of the windows of a benchmark text.

        A text shorter than a window is one window of its own width. Views in which nothing
        else is a placeholder than in that of words are left out, and so is the exact view
        where that of words has all windows.
        """
        views = self(text, VIEWS)
        names = {v: int((views[v].kinds == NAME).sum()) for v in VIEWS}
        first_names = _names(views[CAPITALS]) != _names(views[INNER])
        out = []
        for view, of in views.items():
            if view == INNER and not names[INNER] or view == CAPITALS and not first_names:
                continue
            width = min(self.window, len(of.codes))
            at, hashes = self.windows(of, view, width)
            if view == WORDS:
                whole = len(at) == len(of.codes) - width + 1
            if view == EXACT and whole:
                continue
            out.append((view, width, of, at, hashes))
        return out


def _names(of: View) -> list[str]:
    return [of.slots(i, 1)[0] for i in np.flatnonzero(of.kinds == NAME)]


def _key(of: View, at: int, width: int) -> str:
    """The longest run of literal units in a window, of ``KEY`` words at most."""
    runs, run = [""], []
    for unit in range(at, at + width):
        run = [*run, of.tokens[of.starts[unit]].lower()] if of.kinds[unit] == LITERAL else []
        runs.append(" ".join(run[-KEY:]))
    return max(runs, key=lambda r: (r.count(" "), len(r), r) if r else (-1, 0, r))


def _keys(window: int, literals: int):
    def run(batches):
        make = Templates(window, literals)
        for batch in batches:
            keys = {
                _key(of, p, width)
                for text in batch.column("_content").to_pylist()
                for _, width, of, at, _ in make.asked(text)
                for p in at.tolist()
            }
            yield pa.RecordBatch.from_arrays([pa.array(sorted(keys), pa.string())], ["key"])

    return run


class Keys:
    """Tells whether a text holds a key of any window."""

    def __init__(self, keys: list[str]):
        split = [k.split(" ") for k in keys]
        words = sorted({w for k in split for w in k})
        self.every = "" in words
        #: Marks that are no units are taken out, as in all views.
        self.ids = dict.fromkeys(ENDS | BREAKS, -1) | {w: i for i, w in enumerate(words, 1)}
        self.sums = {}
        for n in sorted({len(k) for k in split}):
            own = np.array([[self.ids[w] for w in k] for k in split if len(k) == n], np.uint64)
            self.sums[n] = np.unique(self._sum(list(own.T)))

    @staticmethod
    def _sum(columns: list[np.ndarray]) -> np.ndarray:
        """A number for each run of words; if two runs share one, a text is looked at in vain."""
        out = np.zeros(len(columns[0]), np.uint64)
        for column in columns:
            out = (out + column) * np.uint64(0x9E3779B97F4A7C15)
        return out

    def __call__(self, text: str) -> bool:
        # letters whose lower case depends on the letters around them, or is two characters
        if self.every or "Σ" in text or "İ" in text:
            return True
        ids = self.ids
        own = np.array([ids.get(t, 0) for t in TOKEN.findall(text.lower())], np.int64)
        own = own[own >= 0].astype(np.uint64)
        known = np.flatnonzero(own)
        for n, sums in self.sums.items():
            starts = known[known <= len(own) - n]
            for k in range(1, n):
                starts = starts[own[starts + k] > 0]
            found = self._sum([own[starts + k] for k in range(n)])
            at = np.minimum(np.searchsorted(sums, found), len(sums) - 1)
            if (sums[at] == found).any():
                return True
        return False


def _windows(window: int, literals: int, wanted=None):
    """Windows of benchmark texts, or those of documents that ``wanted`` has.

    ``wanted`` holds the views and widths of the benchmark's windows and, unless these are
    very many, their sorted hashes and their keys.
    """

    def run(batches):
        known = None if wanted is None else wanted.value
        make = Templates(window, literals)
        near_any = None if known is None or known["keys"] is None else Keys(known["keys"])

        def found(text):
            if known is None:
                yield from make.asked(text)
                return
            if near_any is not None and not near_any(text):
                return
            views = make(text, {view for view, _ in known["shapes"]})
            for view, width in known["shapes"]:
                at, hashes = make.windows(views[view], view, width)
                if known["hashes"] is not None and len(hashes):
                    near = np.searchsorted(known["hashes"], hashes)
                    near[near == len(known["hashes"])] = 0
                    use = known["hashes"][near] == hashes
                    at, hashes = at[use], hashes[use]
                yield view, width, views[view], at, hashes

        for batch in batches:
            rows, out = [], []
            for row, text in enumerate(batch.column("_content").to_pylist()):
                for view, width, of, at, hashes in found(text):
                    for p, h in zip(at.tolist(), hashes.tolist(), strict=True):
                        rows.append(row)
                        out.append((view, p, width, h, of.slots(p, width)))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            at_row = pa.array(rows, pa.int64())
            kinds_ = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id").take(at_row),
                    batch.column("_text").take(at_row),
                    *(pa.array(c, k) for c, k in zip(columns, kinds_, strict=True)),
                ],
                ["_id", "_text", "view", "at", "width", "hash", "slots"],
            )

    return run


def passages(lines: list[tuple[int, int, list]], least: int) -> set[int]:
    """Positions of windows in runs of ``least`` units or more that are consistent in themselves.

    ``lines`` are the windows of a diagonal in order: position, width, and pairs of values.
    """
    out: set[int] = set()
    pairs: dict[str, dict[str, int]] = {}
    left = 0
    done = 0  # windows before this one are in ``out`` already, if they belong there
    torn = 0  # values that stand for several

    def put(k: int, n: int) -> None:
        nonlocal torn
        for value, other in lines[k][2]:
            others = pairs.setdefault(value, {})
            was = len(others) > 1
            others[other] = others.get(other, 0) + n
            if not others[other]:
                del others[other]
            torn += (len(others) > 1) - was

    for right, (at, width, _) in enumerate(lines):
        if right and at - lines[right - 1][0] > lines[right - 1][1]:
            pairs.clear()
            left, torn = right, 0
        put(right, 1)
        while torn:
            put(left, -1)
            left += 1
        if left <= right and at + width - lines[left][0] >= least:
            done = max(done, left)
            out.update(line[0] for line in lines[done : right + 1])
            done = right + 1
    return out


def _held(verbatim: int, template: int):
    """Positions of an item that a diagonal holds, and whether a long passage is among them."""

    def run(batches):
        for batch in batches:
            held, long_ = [], []
            for windows in batch.column("windows").to_pylist():
                lines = sorted(
                    ((w["item_at"], w["width"], list(zip(w["item_slots"], w["slots"], strict=True))) for w in windows),
                    key=lambda line: line[0],
                )
                values = {pair for line in lines for pair in line[2]}
                same = [line for line in lines if all(a == b for a, b in line[2])]
                runs = passages(same, verbatim) | passages(lines, template)
                steady = len({a for a, _ in values}) == len(values)
                held.append([line[0] for line in lines] if steady else sorted(runs))
                long_.append(bool(runs))
            kept = ["_id", "_text", "item", "view"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(held, pa.list_(pa.int32())), pa.array(long_, pa.bool_())],
                [*kept, "held", "passage"],
            )

    return run


def _schema(own: DataFrame) -> str:
    kind = own.schema["_id"].dataType.simpleString()
    return f"_id {kind}, _text binary, view int, at int, width int, hash long, slots array<string>"


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    literals: int = LITERALS,
    covered: float = COVERED,
    verbatim: int = VERBATIM,
    template: int = TEMPLATE,
    sent: int = SENT,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """``_id, _text, item, share``: items whose windows a document holds consistently.

    It must hold the ``covered`` share of them, or ``verbatim`` units in a row word by word, or
    ``template`` units in a row with other values.
    """
    spark = docs.sparkSession
    own = docs.select(*doc_key(id_column, text_column))
    items = benchmark.select(*doc_key(item_column, item_text_column))
    asked = written(items.mapInArrow(_windows(window, literals), _schema(items)))
    sizes = asked.groupBy("_id", "_text", "view").agg(F.count(F.lit(1)).alias("windows"))
    shapes = sorted(map(tuple, asked.select("view", "width").distinct().collect()))
    distinct = asked.select("hash").distinct()
    n = distinct.count()
    hashes = keys = None
    if n <= sent:
        hashes = np.sort(distinct.toArrow().column("hash").to_numpy().astype(np.int64))
        hashes = hashes if len(hashes) else np.zeros(1, np.int64)
        keys = items.mapInArrow(_keys(window, literals), "key string").distinct()
        keys = keys.toArrow().column("key").to_pylist()
    wanted = spark.sparkContext.broadcast({"shapes": shapes, "hashes": hashes, "keys": keys})
    found = own.mapInArrow(_windows(window, literals, wanted), _schema(own))
    item = asked.select(
        F.struct("_id", "_text").alias("item"),
        "view",
        "hash",
        F.col("at").alias("item_at"),
        F.col("slots").alias("item_slots"),
    )
    pairs = found.join(item, ["view", "hash"]).select(
        "_id",
        "_text",
        "item",
        "view",
        (F.col("at") - F.col("item_at")).alias("diagonal"),
        F.struct("item_at", "width", "item_slots", "slots").alias("window"),
    )
    # on a diagonal each value of the item stands for one value of the document
    lines = pairs.groupBy("_id", "_text", "item", "view", "diagonal").agg(
        F.collect_set("window").alias("windows")
    )
    kinds = {c: lines.schema[c].dataType.simpleString() for c in ("_id", "item")}
    held = lines.mapInArrow(
        _held(verbatim, template),
        f"_id {kinds['_id']}, _text binary, item {kinds['item']}, view int, held array<int>, passage boolean",
    )
    shares = (
        held.select("_id", "_text", "item", "view", "passage", F.explode("held").alias("item_at"))
        .groupBy("_id", "_text", "item", "view")
        .agg(F.countDistinct("item_at").alias("held"), F.max("passage").alias("passage"))
        .join(
            sizes.select(F.struct("_id", "_text").alias("item"), "view", "windows"),
            ["item", "view"],
        )
        .where((F.col("held") >= F.lit(covered) * F.col("windows")) | F.col("passage"))
    )
    return shares.groupBy("_id", "_text", "item").agg(
        F.max(F.col("held") / F.col("windows")).alias("share")
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Which documents hold benchmark items.

    Returns ``doc_id, contaminated, item_ids, share``, one row per row of ``docs``: the ids of
    the items of which it holds the ``covered`` share of windows or more, or a passage of
    ``verbatim`` units in a row (``template`` units if values differ), sorted, and the
    largest share it holds of one of them (0 if none). An item shorter than a window is one window; an item
    without words and numbers, like a null or empty one, is in no document. Null and empty documents
    hold nothing. An item without an id counts, but is not listed. Rows that repeat an id and a text get the same result; items that repeat
    are items of their own. Null ids are ids. Other columns are ignored; an empty table on
    either side leaves nothing to find.
    """
    id_column = options.get("id_column", "doc_id")
    found = written(matches(docs, benchmark, **options))
    by_doc = found.groupBy("_id", "_text").agg(
        F.array_sort(F.collect_set("item._id")).alias("item_ids"), F.max("share").alias("share")
    )
    own = docs.select(*doc_key(id_column, options.get("text_column", "text"))).drop("_content")
    by_doc = by_doc.withColumnsRenamed({"_id": "_rid", "_text": "_rtext"})
    same = own["_id"].eqNullSafe(by_doc["_rid"]) & (own["_text"] == by_doc["_rtext"])
    kind = found.schema["item"].dataType["_id"].dataType.simpleString()
    return own.join(by_doc, same, "left").select(
        F.col("_id").alias("doc_id"),
        F.col("share").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast(f"array<{kind}>")).alias("item_ids"),
        F.coalesce("share", F.lit(0.0)).alias("share"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without those that hold a benchmark item; of the others every row stays."""
    gone = written(matches(docs, benchmark, **options)).select("_id", "_text").distinct()
    columns = (options.get("id_column", "doc_id"), options.get("text_column", "text"))
    return without(docs, gone, *columns)
