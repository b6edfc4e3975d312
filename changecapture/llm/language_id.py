"""Language identification by interpolated Kneser-Ney character models.

Every language has a model over characters (letters in lower case; each run of anything
else is one blank). The counts come from a bounded, hash-chosen sample of the labelled rows.
The n-grams of all languages share sorted hash arrays, one per order, with a row of log
probabilities (a column per language) beside each hash: scoring is binary search over whole
batches of characters. The language of least cross-entropy per character wins, and a text
whose cross-entropy is far above what the language's own texts show is rejected.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changecapture.llm.common import shards, written

ORDER = 4
#: Documents of a language that a model is fitted on (expected number; chosen by hash).
SAMPLE = 2000
#: Characters that count as evidence for the score: neighbours are not independent.
EVIDENCE = 50
#: Spreads beyond the usual cross-entropy from which a text is rejected.
TOLERANCE = 12.0
#: Share of a label's texts that its spread is taken from, and that share in deviations of a normal.
QUANTILE, DEVIATIONS = 0.9, 1.645
UNDETERMINED = "und"
PIECE = 1 << 20


def letter_table() -> np.ndarray:
    """Code point -> code point of its lower case, or a blank for anything but letters."""
    table = np.full(0x110000, 32, np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            table[point] = ord(char.lower()[0])
    return table


def letters(text: str, table: np.ndarray) -> np.ndarray:
    """Letters in lower case, each run of others one blank, none at the ends."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = table[points]
    blank = codes == 32
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1]
    codes = codes[keep]
    if len(codes) and codes[0] == 32:
        codes = codes[1:]
    return codes[:-1] if len(codes) and codes[-1] == 32 else codes


def extended(context: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Hash of an n-gram from the hash of all but its last character, and that character."""
    h = (context ^ (code.astype(np.uint64) + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def gram_hashes(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 0 to ``order``, the hash of the n-gram that ends at each position."""
    out = [np.zeros(len(codes), np.uint64)]
    for _ in range(order):
        before = np.concatenate([np.zeros(1, np.uint64), out[-1][:-1]])
        out.append(extended(before, codes))
    return out


@dataclass
class Model:
    languages: list[str]
    order: int
    grams: list[np.ndarray]  # per order, sorted hashes
    logs: list[np.ndarray]  # per order, log probability by language
    contexts: list[np.ndarray]  # per order, sorted hashes of contexts
    backoffs: list[np.ndarray]  # per order, log weight of the lower order by language
    unseen: np.ndarray  # log probability of an unknown character by language
    usual: np.ndarray = None  # cross-entropy of the language's own texts
    spread: np.ndarray = None  # its deviation between long texts
    noise: np.ndarray = None  # its deviation times the root of the length

    def log_probabilities(self, codes: np.ndarray, skip: int) -> np.ndarray:
        """Rows for the positions from ``skip`` on; the first ``skip`` codes are context."""
        hashes = gram_hashes(codes, self.order)
        n = len(codes) - skip
        total = np.zeros((n, len(self.languages)), np.float32)
        open_ = np.arange(n)
        for order in range(self.order, 0, -1):
            at, hit = _find(self.grams[order - 1], hashes[order][skip + open_])
            total[open_[hit]] += self.logs[order - 1][at[hit]]
            open_ = open_[~hit]
            if not len(open_):
                return total
            if order > 1:
                at, hit = _find(self.contexts[order - 1], hashes[order - 1][skip + open_ - 1])
                total[open_[hit]] += self.backoffs[order - 1][at[hit]]
        total[open_] += self.unseen
        return total

    def sums(self, texts: list[np.ndarray]) -> np.ndarray:
        """Log probability of each text by language, in batches of bounded size."""
        pad = self.order - 1
        out = np.zeros((len(texts), len(self.languages)))
        owners, pieces, size = [], [], 0
        for owner, codes in enumerate(texts):
            whole = np.concatenate([np.zeros(pad, np.uint32), codes])
            for start in range(0, len(codes), PIECE):
                piece = whole[start : start + PIECE + pad]
                owners.append(owner)
                pieces.append(piece)
                size += len(piece)
                if size > PIECE:
                    self._add(out, owners, pieces)
                    owners, pieces, size = [], [], 0
        if pieces:
            self._add(out, owners, pieces)
        return out

    def _add(self, out: np.ndarray, owners: list[int], pieces: list[np.ndarray]) -> None:
        pad = self.order - 1
        sizes = np.array([len(p) for p in pieces])
        logs = self.log_probabilities(np.concatenate(pieces), pad)
        # the padding of the next piece is scored too, and left out of the sums
        upto = np.concatenate([np.zeros((1, logs.shape[1])), np.cumsum(logs, axis=0, dtype=np.float64)])
        start = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        np.add.at(out, owners, upto[start + sizes - pad] - upto[start])

    def entropies(self, texts: list[np.ndarray]) -> np.ndarray:
        """Cross-entropy per character (nats) of each text by language."""
        sizes = np.maximum([len(t) for t in texts], 1)
        return -self.sums(texts) / sizes[:, None]

    def bound(self, language: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Cross-entropy from which a text of this language and length is rejected."""
        deviation = self.spread[language] + self.noise[language] / np.sqrt(np.maximum(size, 1))
        return self.usual[language] + TOLERANCE * deviation


def _find(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(known):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return at, known[at] == wanted


def kneser_ney(counts: list[dict[str, int]], languages: list[str], order: int) -> Model:
    """Models of all languages from their counts of n-grams of the highest order.

    Lower orders count in how many contexts an n-gram is seen, as usual.
    """
    seen = [[None] * order for _ in languages]  # by language and order: n-gram -> count
    for k, own in enumerate(counts):
        seen[k][order - 1] = own
        for n in range(order - 1, 0, -1):
            seen[k][n - 1] = Counter(g[1:] for g in seen[k][n])
    characters = max(1, len({g for own in seen for g in own[0]})) + 1
    grams, logs, contexts, backoffs = [], [], [], []
    lower: dict[str, np.ndarray] = {}
    unseen = None
    for n in range(1, order + 1):
        union = sorted({g for own in seen for g in own[n - 1]})
        context_union = sorted({g[:-1] for g in union})
        where = {c: i for i, c in enumerate(context_union)}
        gram_context = np.array([where[g[:-1]] for g in union], np.int64)
        if n == 1:
            below = np.full((len(union), len(languages)), 1 / characters)
        else:
            below = np.array([lower[g[1:]] for g in union]).reshape(-1, len(languages))
        weight = np.ones((len(context_union), len(languages)))
        chance = np.zeros((len(union), len(languages)))
        for k in range(len(languages)):
            own = np.array([seen[k][n - 1].get(g, 0) for g in union], np.float64)
            once, twice = (own == 1).sum(), (own == 2).sum()
            discount = once / (once + 2 * twice) if once else 0.5
            discount = min(max(discount, 0.1), 0.9)
            total = np.bincount(gram_context, own, len(context_union))
            kinds = np.bincount(gram_context, own > 0, len(context_union))
            known = total > 0
            weight[known, k] = discount * kinds[known] / total[known]
            chance[:, k] = np.maximum(own - discount, 0) / np.maximum(total, 1)[gram_context]
        chance += weight[gram_context] * below
        lower = dict(zip(union, chance, strict=True))
        if n == 1:
            unseen = np.log(weight[0] / characters) if len(weight) else np.zeros(len(languages))
        for strings, values, hashes, columns in (
            (union, chance, grams, logs),
            (context_union, weight, contexts, backoffs),
        ):
            size = len(strings[0]) if strings else 0
            h = np.zeros(len(strings), np.uint64)
            for i in range(size):
                h = extended(h, np.array([ord(g[i]) for g in strings], np.uint32))
            by = np.argsort(h)
            hashes.append(h[by])
            columns.append(np.log(values[by]).astype(np.float32))
    return Model(languages, order, grams, logs, contexts, backoffs, unseen.astype(np.float32))


def _counted(order: int, table):
    def run(batches):
        for batch in batches:
            found: Counter = Counter()
            langs = batch.column("lang").to_pylist()
            for lang, text in zip(langs, batch.column("text").to_pylist(), strict=True):
                codes = letters(text, table.value).tolist()
                string = "\0" * (order - 1) + "".join(map(chr, codes))
                found.update((lang, string[i : i + order]) for i in range(len(codes)))
            if found:
                keys = list(found)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k[0] for k in keys]),
                        pa.array([k[1] for k in keys]),
                        pa.array(list(found.values()), pa.int64()),
                    ],
                    ["lang", "gram", "n"],
                )

    return run


def _measured(model, table):
    """Sufficient statistics of the cross-entropy of the sample under its own language."""

    def run(batches):
        m = Model(**model.value)
        index = {lang: k for k, lang in enumerate(m.languages)}
        for batch in batches:
            langs = [index[x] for x in batch.column("lang").to_pylist()]
            texts = [letters(x, table.value) for x in batch.column("text").to_pylist()]
            if not texts:
                continue
            sizes = np.array([len(t) for t in texts])
            own = m.entropies(texts)[np.arange(len(texts)), langs]
            use = sizes > 0
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array(langs)[use], pa.int32()),
                    pa.array(sizes[use], pa.int64()),
                    pa.array(own[use], pa.float64()),
                ],
                ["lang", "size", "entropy"],
            )

    return run


def fit(
    docs: DataFrame,
    label_column: str = "lang",
    text_column: str = "text",
    id_column: str = "doc_id",
    order: int = ORDER,
    sample: int = SAMPLE,
) -> Model:
    """A model of the labels in ``docs``; rows without label or text are no examples.

    ``sample`` bounds the documents of a label, in expectation: rows are chosen by a hash of id
    and text, and of rows that repeat both one is taken. It is the only bound: all n-grams of the
    chosen documents are counted. Ids choose rows, they are no input of the model. Without any
    labelled text the model has no language, and ``identify`` finds none.
    """
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(letter_table())
    rows = docs.select(
        F.col(label_column).cast("string").alias("lang"),
        F.col(text_column).alias("text"),
        F.xxhash64(id_column, text_column).alias("draw"),
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return Model([], order, [], [], [], [], np.zeros(0))
    languages = sorted(sizes)
    buckets = 1 << 20
    share = F.create_map(
        *[F.lit(x) for k in languages for x in (k, min(buckets, -(-sample * buckets // sizes[k])))]
    )
    chosen = rows.where(F.pmod("draw", F.lit(buckets)) < share[F.col("lang")])
    chosen = chosen.groupBy("lang", "draw").agg(F.first("text").alias("text")).select("lang", "text", "draw")
    chosen = written(chosen.repartition(shards(docs)))
    found = (
        chosen.mapInArrow(_counted(order, table), "lang string, gram string, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    # a label all of whose rows repeat a few texts may have nothing chosen
    languages = sorted(set(found["lang"]))
    counts = [
        dict(zip(own["gram"], own["n"], strict=True))
        for own in (found[found["lang"] == k] for k in languages)
    ]
    model = kneser_ney(counts, languages, order)
    sent = spark.sparkContext.broadcast(vars(model))
    own = chosen.mapInArrow(_measured(sent, table), "lang int, size long, entropy double")
    # quantiles, so that up to a tenth of foreign or garbled texts under a label move no bound
    own = written(own)
    usual = own.where("size > 0").groupBy("lang").agg(
        F.percentile("entropy", 0.5, F.least("size", F.lit(500))).alias("usual")
    )
    usual = {r["lang"]: r["usual"] for r in usual.collect()}
    model.usual = np.array([usual.get(k, 0.0) for k in range(len(languages))])
    pairs = [F.lit(x) for k in range(len(languages)) for x in (k, float(model.usual[k]))]
    off = F.abs(F.col("entropy") - F.create_map(*pairs)[F.col("lang")]) if pairs else F.lit(0.0)
    # what the deviation of a text would be at 500 letters: most of a short one's is chance
    settled = F.sqrt(F.least("size", F.lit(500)) / 500.0)
    spreads = own.where("size > 0").groupBy("lang").agg(
        (F.percentile(off * settled, QUANTILE) / DEVIATIONS).alias("spread")
    )
    spreads = spreads.withColumn("noise", F.col("spread") * F.sqrt(F.lit(500.0)))
    spreads = {r["lang"]: r for r in spreads.collect()}
    value = lambda k, name: (spreads[k][name] if k in spreads else None) or 0.05
    model.spread = np.array([value(k, "spread") for k in range(len(languages))])
    model.noise = np.array([value(k, "noise") for k in range(len(languages))])
    sent.destroy()
    return model


RESULTS = {"lang_pred": "string", "score": "double", "entropy": "double", "accepted": "boolean"}


def _predicted(model, table, content: str, kept: list[str]):
    def run(batches):
        m = Model(**model.value)
        for batch in batches:
            texts = [letters(x or "", table.value) for x in batch.column(content).to_pylist()]
            if not texts:
                continue
            sizes = np.array([len(t) for t in texts])
            entropy = m.entropies(texts)
            best = entropy.argmin(axis=1)
            least = entropy[np.arange(len(texts)), best]
            evidence = np.minimum(sizes, EVIDENCE)[:, None]
            score = 1 / np.exp((least[:, None] - entropy) * evidence).sum(axis=1)
            some = sizes > 0
            names = [m.languages[k] if s else UNDETERMINED for k, s in zip(best, some, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in kept),
                    pa.array(names, pa.string()),
                    pa.array(np.where(some, score, 0.0)),
                    pa.array(least, mask=~some),
                    pa.array(some & (least <= m.bound(best, sizes))),
                ],
                [*kept, *RESULTS],
            )

    return run


def identify(
    docs: DataFrame, model: Model, text_column: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Predict the language of every whole text.

    The columns ``keep`` (all, if not given) but those named like results are kept, and
    ``lang_pred``, ``score`` (0 to 1: the weight of the language among all, on at most
    ``EVIDENCE`` characters), ``entropy`` (per character) and ``accepted`` are added. A null
    text or one without letters is ``und``, with score 0, no entropy, and not accepted, and so is
    every text under a model without languages. Of
    equally likely languages the first by name wins. Repeated rows give repeated results;
    an empty table gives an empty one.
    """
    spark = docs.sparkSession
    kept = [c for c in (docs.columns if keep is None else keep) if c not in RESULTS]
    if not model.languages:
        nothing = {"lang_pred": UNDETERMINED, "score": 0.0, "entropy": None, "accepted": False}
        return docs.select(
            *[F.col(f"`{c}`") for c in kept],
            *[F.lit(v).cast(RESULTS[c]).alias(c) for c, v in nothing.items()],
        )
    sent = spark.sparkContext.broadcast(vars(model))
    table = spark.sparkContext.broadcast(letter_table())
    own = docs.select(*dict.fromkeys([*kept, text_column]))
    schema = [f"`{c}` {own.schema[c].dataType.simpleString()}" for c in kept]
    schema += [f"{name} {kind}" for name, kind in RESULTS.items()]
    return own.mapInArrow(_predicted(sent, table, text_column, kept), ", ".join(schema))
