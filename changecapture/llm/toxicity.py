"""Toxicity scores: a learned lexicon, matched through a Levenshtein automaton, in context.

The lexicon is learned from labelled documents as a trie: a word, or a stem of many words,
that occurs in toxic documents and hardly in others. The trie is intersected with the
Levenshtein automaton of one edit (a swap of neighbouring letters is one) into a single deterministic automaton, built as it is
walked: most words leave it after two or three letters. Each hit is weighed by the window of
words around it: one inside quotation marks that open and close there is quoted, not said.
A logistic model of the hits of each kind, fitted on the same labelled rows, gives the score.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changecapture.llm.common import shards, written

WORD = re.compile(r"\w+")
#: Labelled documents of each label that the model is fitted on (expected; chosen by hash).
SAMPLE = 6000
#: Toxic documents that a term occurs in, and its least share of them among all its documents.
SUPPORT = 5
PURITY = 0.97
#: Letters of a stem, and of a term that may be misspelled. One of ``STEM`` letters may be, if
#: the labelled documents with words so close to it are as purely toxic as a term's.
STEM = 4
FUZZY = 5
#: Words on each side of a hit that are its context.
WINDOW = 12
END = "$"
QUOTES = {'"': '"', "“": "”", "„": "“”", "«": "»", "‘": "’", "‹": "›"}

NOTHING, EXACT, MISSPELLED = 0, 1, 2


def lexicon_of(nodes: dict[str, tuple[int, int]]) -> list[str]:
    """Terms from trie nodes: prefix -> (toxic documents, other documents).

    The shortest pure prefixes are followed down while one child keeps nearly all of their
    documents. Where they branch, a prefix of ``STEM`` letters or more is a stem; a shorter
    one is left for its children. Whole words end with ``$``.
    """
    children: dict[str, list[str]] = {}
    for prefix in nodes:
        children.setdefault(prefix[:-1], []).append(prefix)

    def pure(prefix: str) -> bool:
        toxic, other = nodes[prefix]
        return toxic >= SUPPORT and toxic >= PURITY * (toxic + other)

    out = []
    pending = [p for p in nodes if p[:-1] not in nodes]
    while pending:
        prefix = pending.pop()
        below = children.get(prefix, [])
        if not pure(prefix):
            pending += below
            continue
        if prefix.endswith(END):
            out.append(prefix)
            continue
        main = [p for p in below if nodes[p][0] >= 0.9 * nodes[prefix][0]]
        if len(main) == 1:
            pending += main
        elif len(prefix) >= STEM:
            out.append(prefix)
        else:
            pending += below
    return sorted(out)


def words_under(nodes: dict[str, tuple[int, int]], terms: list[str]) -> list[str]:
    """Whole words of the nodes that begin with a stem among the terms, and are pure themselves."""
    stems = {t for t in terms if not t.endswith(END)}
    return sorted(
        prefix
        for prefix, (toxic, other) in nodes.items()
        if prefix.endswith(END)
        and toxic >= SUPPORT
        and toxic >= PURITY * (toxic + other)
        and any(prefix[:i] in stems for i in range(STEM, len(prefix)))
    )


class Matcher:
    """Words within one edit of a term; stems match the beginning of a word.

    With ``swaps`` two neighbouring letters that change places are one edit. Terms in ``short``
    may be misspelled though they have fewer than ``FUZZY`` letters.
    """

    def __init__(self, terms: list[str], edits: int = 1, swaps: bool = False, short=()):
        self.edits, self.swaps = edits, swaps
        self.children: list[dict[str, int]] = [{}]
        self.ends: dict[int, bool] = {}  # node -> may be misspelled
        self.stems: dict[int, bool] = {}
        for term in terms:
            word = term.removesuffix(END)
            node = 0
            for char in word:
                if char not in self.children[node]:
                    self.children[node][char] = len(self.children)
                    self.children.append({})
                node = self.children[node][char]
            (self.ends if term.endswith(END) else self.stems)[node] = len(word) >= FUZZY or term in short
        self.states: dict[frozenset, int] = {}
        self.sets: list[dict[int, int]] = []
        self.verdicts: list[int] = []
        self.settled: list[int] = []
        self.steps: list[dict[str, int]] = []
        self.start = self._state({0: 0})

    def _state(self, configs: dict) -> int:
        """Number of a set of (node, edits so far), closed under skipped letters.

        In the middle of a swap the node is a pair: that after it, and the letter to come.
        """
        todo = list(configs.items())
        for node, edits in todo:
            if edits < self.edits and not isinstance(node, tuple):
                for child in self.children[node].values():
                    if configs.get(child, self.edits + 1) > edits + 1:
                        configs[child] = edits + 1
                        todo.append((child, edits + 1))
        key = frozenset(configs.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(configs)
            self.steps.append({})

            def best(accepting):
                hits = [e for n, e in configs.items() if n in accepting and (e == 0 or accepting[n])]
                return (EXACT if min(hits) == 0 else MISSPELLED) if hits else NOTHING

            # a stem must be spelled right: one edit in a beginning fits too many words
            self.settled.append(EXACT if any(e == 0 and n in self.stems for n, e in configs.items()) else NOTHING)
            self.verdicts.append(best(self.ends))
        return self.states[key]

    def _step(self, state: int, char: str) -> int:
        after: dict = {}

        def put(node, edits: int) -> None:
            if edits <= self.edits and after.get(node, self.edits + 1) > edits:
                after[node] = edits

        for node, edits in self.sets[state].items():
            if isinstance(node, tuple):
                if node[1] == char:
                    put(node[0], edits)
                continue
            put(node, edits + 1)
            for letter, child in self.children[node].items():
                put(child, edits + (letter != char))
                if self.swaps and letter != char and char in self.children[child]:
                    put((self.children[child][char], letter), edits + 1)
        self.steps[state][char] = to = self._state(after) if after else -1
        return to

    def __call__(self, word: str) -> int:
        state, steps = self.start, self.steps
        for char in word:
            to = steps[state].get(char)
            state = self._step(state, char) if to is None else to
            if state < 0:
                return NOTHING
            if self.settled[state]:
                return self.settled[state]
        return self.verdicts[state]


def quoted(text: str, start: int, end: int, window: int = WINDOW) -> bool:
    """Whether a quotation opens before and closes after ``[start, end)`` in its context."""
    before = " ".join(text[max(0, start - 20 * window) : start].split(" ")[-window - 1 :])
    after = " ".join(text[end : end + 20 * window].split(" ")[: window + 1])
    before, after = before.rpartition("\n")[2], after.partition("\n")[0]
    for opening, closing in QUOTES.items():
        if opening == closing:
            if before.count(opening) % 2 and closing in after:
                return True
        elif before.rfind(opening) > max(before.rfind(c) for c in closing) and any(c in after for c in closing):
            return True
    return False


def _prefixes():
    def run(batches):
        for batch in batches:
            found: dict[int, Counter] = {0: Counter(), 1: Counter()}
            toxic = batch.column("toxic").to_pylist()
            for label, text in zip(toxic, batch.column("_content").to_pylist(), strict=True):
                words = set(WORD.findall(text.lower()))
                nodes = {w[:i] for w in words for i in range(1, len(w) + 1)}
                nodes.update(w + END for w in words)
                found[label].update(nodes)
            for label, counts in found.items():
                if counts:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(list(counts), pa.string()),
                            pa.array(np.full(len(counts), label), pa.int32()),
                            pa.array(list(counts.values()), pa.int64()),
                        ],
                        ["prefix", "toxic", "n"],
                    )

    return run


def _near(terms, candidates):
    """Documents of each label with a misspelled form of each candidate that is no term."""

    def run(batches):
        exact = Matcher(terms.value)
        each = {c: Matcher([c], swaps=True, short={c}) for c in candidates.value}
        some = Matcher(candidates.value, swaps=True, short=set(candidates.value))
        close: dict[str, list[str]] = {}
        for batch in batches:
            found: Counter = Counter()
            labels = batch.column("toxic").to_pylist()
            for label, text in zip(labels, batch.column("_content").to_pylist(), strict=True):
                hit = set()
                for word in set(WORD.findall(text.lower())):
                    if word not in close:
                        if len(close) > 200_000:
                            close.clear()
                        use = some(word) == MISSPELLED and exact(word) != EXACT
                        close[word] = [c for c, m in each.items() if m(word) == MISSPELLED] if use else []
                    hit.update(close[word])
                found.update((c, label) for c in hit)
            if found:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([c for c, _ in found], pa.string()),
                        pa.array([k for _, k in found], pa.int32()),
                        pa.array(list(found.values()), pa.int64()),
                    ],
                    ["term", "toxic", "n"],
                )

    return run


class Counted:
    """Hits of a text: exact, misspelled, and quoted ones."""

    def __init__(self, terms: list[str], short: list[str]):
        self.match = Matcher(terms, swaps=True, short=set(short))
        self.seen: set[str] = set()
        self.hits: dict[str, int] = {}

    def __call__(self, text: str) -> tuple[int, int, int]:
        lower = text.lower()
        words = set(WORD.findall(lower))
        if len(self.seen) > 200_000:
            self.seen.clear()
        new = words - self.seen
        self.seen |= new
        for word in new:
            if kind := self.match(word):
                self.hits[word] = kind
        if words.isdisjoint(self.hits):
            return 0, 0, 0
        counts = [0, 0, 0]
        for found in WORD.finditer(lower):
            kind = self.hits.get(found.group())
            if kind:
                counts[2 if quoted(lower, found.start(), found.end()) else kind - 1] += 1
        return tuple(counts)


def _features(terms, content: str, kept: list[str]):
    def run(batches):
        count = Counted(*terms.value)
        for batch in batches:
            found = [count(x or "") for x in batch.column(content).to_pylist()]
            columns = list(zip(*found, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *(pa.array(c, pa.int64()) for c in columns)],
                [*kept, "exact", "misspelled", "quoted"],
            )

    return run


@dataclass
class Model:
    terms: list[str]
    weights: list[float]  # bias, exact, misspelled, quoted
    short: list[str] = field(default_factory=list)  # terms of few letters that may be misspelled


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weights of a logistic model of grouped rows (Newton's method, ridge on all but the bias)."""
    x = np.column_stack([np.ones(len(x)), x])
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        gradient = x.T @ (n * (y - p)) - penalty * w
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def features(frame: DataFrame) -> list:
    return [F.log1p(F.col(c).cast("double")) for c in ("exact", "misspelled", "quoted")]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_column: str = "toxic",
    id_column: str = "doc_id",
    text_column: str = "text",
    sample: int = SAMPLE,
) -> Model:
    """Learn lexicon and weights from ``labels`` (id, 0/1) of ``docs``.

    Null labels are no examples; of several labels of an id the highest counts. ``sample``
    bounds the documents of each label, in expectation: ids are chosen by hash, and texts by a
    hash of id and text where the ids have more than twice as many. Of rows that repeat an id and
    a text one is taken. All words of the chosen documents count. Without toxic examples the
    lexicon is empty.
    """
    spark = docs.sparkSession
    known = (
        labels.select(F.col(id_column).alias("_id"), F.col(label_column).cast("int").alias("toxic"))
        .where("_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    buckets = 1 << 20
    share = lambda k: min(buckets, -(-sample * buckets // max(1, sizes.get(k, 0))))
    limit = F.when(F.col("toxic") == 1, share(1)).otherwise(share(0))
    # about 2 x sample rows of two numbers, whatever the size of the tables
    drawn = F.broadcast(known.where(F.pmod(F.xxhash64("_id"), F.lit(buckets)) < limit))
    chosen = written(
        docs.select(F.col(id_column).alias("_id"), F.coalesce(F.col(text_column), F.lit("")).alias("_content"))
        .join(drawn, "_id")
        .groupBy("toxic", F.xxhash64("_id", "_content").alias("_draw"))
        .agg(F.first("_content").alias("_content"))
        .repartition(shards(docs))
    )
    # an id may have any number of texts: beyond twice the sample they are drawn one by one
    found = {r["toxic"]: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    share = lambda k: min(buckets, -(-2 * sample * buckets // max(1, found.get(k, 0))))
    limit = F.when(F.col("toxic") == 1, share(1)).otherwise(share(0))
    chosen = chosen.where(F.pmod("_draw", F.lit(buckets)) < limit).select("toxic", "_content")
    # rows of a label stand for this many of it
    weigh = {k: max(1.0, sizes.get(k, 0) / sample) for k in (0, 1)}
    nodes = (
        chosen.mapInArrow(_prefixes(), "prefix string, toxic int, n long")
        .groupBy("prefix")
        .agg(
            F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"),
            F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("other"),
        )
        .where(F.col("toxic") >= SUPPORT)
        .collect()
    )
    nodes = {r["prefix"]: (r["toxic"], round(r["other"] * weigh[0] / weigh[1])) for r in nodes}
    terms = lexicon_of(nodes)
    terms = sorted({*terms, *words_under(nodes, terms)})
    short = [t for t in terms if t.endswith(END) and len(t) - 1 == STEM]
    if short:
        near = chosen.mapInArrow(
            _near(spark.sparkContext.broadcast(terms), spark.sparkContext.broadcast(short)),
            "term string, toxic int, n long",
        )
        near = {(r["term"], r["toxic"]): r["n"] for r in near.groupBy("term", "toxic").agg(F.sum("n").alias("n")).collect()}
        clean = lambda t: near.get((t, 0), 0) * weigh[0] / weigh[1]
        short = [t for t in short if near.get((t, 1), 0) >= PURITY * (near.get((t, 1), 0) + clean(t))]
    sent = spark.sparkContext.broadcast((terms, short))
    counted = chosen.mapInArrow(
        _features(sent, "_content", ["toxic"]), "toxic int, exact long, misspelled long, quoted long"
    )
    # few distinct values: logarithms to one decimal
    x = [F.round(c, 1).alias(f"x{i}") for i, c in enumerate(features(counted))]
    rows = counted.select("toxic", *x).groupBy("toxic", "x0", "x1", "x2").count().collect()
    if not rows:
        return Model(terms, [0.0, 0.0, 0.0, 0.0], short)
    values = np.array([[r["x0"], r["x1"], r["x2"]] for r in rows])
    toxic = np.array([r["toxic"] for r in rows], np.float64)
    n = np.array([r["count"] * weigh[r["toxic"]] for r in rows])
    return Model(terms, logistic(values, toxic, n).tolist(), short)


def score(
    docs: DataFrame, model: Model, text_column: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Score every whole text; adds ``score`` (0 to 1) and the hits of each kind.

    The columns ``keep`` (all, if not given) but those named like results are kept. Null
    texts are empty texts, which have no hits, like all texts without terms. Repeated rows
    give repeated results; an empty table gives an empty one.
    """
    results = ["score", "exact", "misspelled", "quoted"]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in results]
    own = docs.select(*dict.fromkeys([*kept, text_column]))
    schema = [f"`{c}` {own.schema[c].dataType.simpleString()}" for c in kept]
    sent = docs.sparkSession.sparkContext.broadcast((model.terms, model.short))
    found = own.mapInArrow(
        _features(sent, text_column, kept),
        ", ".join([*schema, "exact long", "misspelled long", "quoted long"]),
    )
    total = F.lit(model.weights[0])
    for weight, value in zip(model.weights[1:], features(found), strict=True):
        total = total + F.lit(weight) * value
    return found.withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-total)))
