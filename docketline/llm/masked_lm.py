"""Document scores by masked pseudo-likelihood.

A bidirectional window network, trained in numpy, predicts every token of a text
from the two tokens on each side; the sum of the conditional log-probabilities is
the document's score.

Tokens are words after lower-casing A-Z, hashed to ``2 ** TOKEN_BITS`` buckets.
The probability of a token is that of its class given both sides (the network's
softmax over CLASSES classes of about equal mass) times that of the token in its
class (its share of the class's count over the whole corpus, plus one), which
sums to one over all tokens.

1. One pass hashes the texts and writes two bytes a token.
2. Token counts over all documents are summed by Spark in slices.
3. Training: in each round every task starts from the same weights and trains on
   masked positions of all its documents (one in MASK, another residue each
   round, by document and place; the rounds together mask every position once);
   Spark averages the tasks' weights in slices, weighted by positions. What is
   gathered is a fixed 1.6 MB a task and round, so it follows the input.
4. Scoring: every token of every document, in blocks.

Counts, training and scores cover all documents; the driver holds the weights
and the count table only, both of fixed size.

Defined results: null, empty and wordless texts have 0 tokens, a log-likelihood
of 0 and a null mean; places beyond a text's edges are a token of their own; ties
and repeated rows get equal scores; an empty table gives an empty result. The
result has its own columns only.

Each task trains its own copy of the network in a round, and the copies are averaged by
the number of positions they trained on; so scores depend on how the table is dealt
to tasks (and not on the order in which tasks end).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketline.llm.common import materialize

TOKEN_BITS = 16
CONTEXT_BITS = 12
SIDE = 2
HIDDEN = 24
CLASSES = 64
ROUNDS = 3
#: As many as rounds: every position is a target in just one of them.
MASK = ROUNDS
BATCH = 2048
RATE = 0.08
SLICES = 16
FAN = 16
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


class TokenIds(dict):
    """Bucket of each word, remembered while there is room. Bucket 0 is the edge."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 200_000:
            self.clear()
        h = self[word] = 1 + xxhash.xxh64_intdigest(word) % ((1 << TOKEN_BITS) - 1)
        return h


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids = TokenIds()
    for b in batches:
        out = [np.array(list(map(ids.__getitem__, t.translate(_LOWER).split())), np.uint16).tobytes() if t else b""
               for t in b.column(1).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["id", "tokens"])


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, their contexts (one row a token: SIDE on the left, SIDE on the
    right) and the number of each token's text."""
    arrays = [np.frombuffer(t, np.uint16) for t in texts]
    sizes = np.array([len(a) for a in arrays], np.int64)
    gap = np.zeros(SIDE, np.uint16)
    flat = np.concatenate([x for a in arrays for x in (gap, a)] + [gap]).astype(np.int32)
    doc = np.repeat(np.arange(len(arrays)), sizes)
    at = np.arange(int(sizes.sum())) + SIDE * (doc + 1)
    near = [k for k in range(-SIDE, SIDE + 1) if k]
    mask = (1 << CONTEXT_BITS) - 1
    context = np.stack([flat[at + k] & mask for k in near], axis=1) if len(at) else np.zeros((0, 2 * SIDE), np.int32)
    return flat[at], context, doc


def blocks(texts: list[bytes], tokens: int = 400_000) -> Iterator[tuple[int, int]]:
    """Index ranges of texts with about ``tokens`` tokens each."""
    start = held = 0
    for i, t in enumerate(texts):
        held += len(t) // 2
        if held >= tokens:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def targets(ids: np.ndarray, doc: np.ndarray, r: int, mask: int = MASK) -> np.ndarray:
    """The positions that round ``r`` masks: those whose hash of text id and place
    in the text has the round's residue. Every position is in one residue."""
    place = np.arange(len(doc)) - np.searchsorted(doc, doc)
    with np.errstate(over="ignore"):
        h = ids.astype(np.int64).view(np.uint64)[doc] * np.uint64(0x9E3779B97F4A7C15) + place.astype(np.uint64)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
    return np.flatnonzero((h >> np.uint64(33)) % np.uint64(mask) == r % mask)


class Network:
    """softmax(tanh(sum of a row for each context place + b) W + c)."""

    SHAPES = [(2 * SIDE << CONTEXT_BITS, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,)]

    def __init__(self, weights: np.ndarray):
        self.weights, self.parts, at = weights, [], 0
        for s in self.SHAPES:
            n = int(np.prod(s))
            self.parts.append(weights[at:at + n].reshape(s))
            at += n

    @classmethod
    def start(cls, class_mass: np.ndarray) -> "Network":
        rng = np.random.default_rng(1)
        parts = [rng.normal(0, 0.1, s).astype(np.float32) for s in cls.SHAPES]
        parts[1][:] = 0
        parts[3][:] = np.log(class_mass / class_mass.sum())
        return cls(np.concatenate([p.ravel() for p in parts]))

    def forward(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of the table, hidden values, and log-probabilities of all classes."""
        table, b, w, c = self.parts
        rows = context + (np.arange(context.shape[1], dtype=np.int32) << CONTEXT_BITS)
        h = table.take(rows[:, 0], axis=0)
        for k in range(1, rows.shape[1]):
            h += table.take(rows[:, k], axis=0)
        h += b
        np.tanh(h, out=h)
        z = h @ w
        z += c
        z -= z.max(axis=1, keepdims=True)
        z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
        return rows, h, z

    def log_probs(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log-probability of each position's target class, in steps that stay in the cache."""
        out = np.zeros(len(target), np.float32)
        for i in range(0, len(target), BATCH):
            t = target[i:i + BATCH]
            out[i:i + BATCH] = self.forward(context[i:i + BATCH])[2][np.arange(len(t)), t]
        return out

    def learn(self, context: np.ndarray, target: np.ndarray, seen: list[np.ndarray]) -> None:
        """One step on a batch, each weight with its own rate (Adagrad)."""
        rows, h, d = self.forward(context)
        np.exp(d, out=d)
        d[np.arange(len(target)), target] -= 1
        d /= len(target)
        dh = d @ self.parts[2].T
        dh *= 1 - h * h
        flat = rows.ravel(order="F")
        order = np.argsort(flat.astype(np.uint16), kind="stable")  # there are 2 * SIDE << CONTEXT_BITS <= 2 ** 16 rows
        ranked = flat[order]
        first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        used = ranked[first]
        g = np.add.reduceat(dh.take(order % len(dh), axis=0), first, axis=0)
        moved = seen[0].take(used, axis=0)
        moved += g * g
        seen[0][used] = moved
        g *= RATE
        moved += 1e-8
        g /= np.sqrt(moved, out=moved)
        self.parts[0][used] -= g
        for k, grad in ((1, dh.sum(axis=0)), (2, h.T @ d), (3, d.sum(axis=0))):
            seen[k] += grad * grad
            self.parts[k] -= RATE * grad / np.sqrt(seen[k] + 1e-8)


def _sum_slices(df: DataFrame, kind: type, tables: int) -> np.ndarray:
    """Sum the arrays of ``tables`` tasks, slice by slice, FAN at a time, so a group
    holds a few slices however many tasks there are; their length is fixed."""
    def add(t: pa.Table) -> pa.Table:
        t = t.sort_by("turn")  # the same sum in whatever order the rows come
        total = sum(np.frombuffer(x, kind) for x in t.column("part").to_pylist())
        return pa.table({"slice": t.column("slice")[:1], "turn": t.column("fan")[:1], "part": pa.array([total.tobytes()], pa.binary())})

    while tables > 1:
        df = df.withColumn("fan", F.floor(F.col("turn") / F.lit(FAN)).cast("int")).groupBy("slice", "fan").applyInArrow(add, _SLICE_DDL)
        tables = -(-tables // FAN)
    rows = df.collect()
    return np.concatenate([np.frombuffer(r["part"], kind) for r in sorted(rows, key=lambda r: r["slice"])] or [np.zeros(0, kind)])


_SLICE_DDL = "slice int, turn int, part binary"


def _slices(array: np.ndarray) -> pa.RecordBatch:
    turn = TaskContext.get().partitionId()
    return pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([turn] * SLICES, pa.int32()),
                                       pa.array([x.tobytes() for x in np.array_split(array, SLICES)], pa.binary())], names=["slice", "turn", "part"])


def token_counts(tokens: DataFrame) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << TOKEN_BITS, np.int64)
        for b in batches:
            for t in b.column(0).to_pylist():
                total += np.bincount(np.frombuffer(t, np.uint16), minlength=len(total)) if len(t) > 20_000 else 0
                if 0 < len(t) <= 20_000:
                    np.add.at(total, np.frombuffer(t, np.uint16), 1)
        yield _slices(total)

    found = _sum_slices(tokens.select("tokens").mapInArrow(run, _SLICE_DDL), np.int64, tokens.rdd.getNumPartitions())
    return found if len(found) else np.zeros(1 << TOKEN_BITS, np.int64)


def classes_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The class of each token, log of its share in the class, class masses:
    tokens by falling count, cut into classes of about equal mass."""
    mass = counts + 1.0
    order = np.argsort(-mass, kind="stable")
    cls = np.zeros(len(mass), np.int64)
    upto = np.cumsum(mass[order]) - mass[order] / 2
    cls[order] = np.minimum((upto / mass.sum() * CLASSES).astype(np.int64), CLASSES - 1)
    per = np.bincount(cls, mass, CLASSES)
    return cls, np.log(mass / per[cls]), np.maximum(per, 1e-9)


def train(tokens: DataFrame, cls: np.ndarray, class_mass: np.ndarray, rounds: int = ROUNDS, mask: int = MASK) -> Network:
    spark = tokens.sparkSession
    net = Network.start(class_mass)
    shared_cls = spark.sparkContext.broadcast(cls)
    for r in range(rounds):
        start = spark.sparkContext.broadcast(net.weights)

        def run(batches: Iterator[pa.RecordBatch], r: int = r, start=start) -> Iterator[pa.RecordBatch]:
            own, classes = Network(start.value.copy()), shared_cls.value
            seen = [np.full(s, 1e-4, np.float32) for s in Network.SHAPES]
            done = 0
            for b in batches:
                ids, texts = b.column(0).fill_null(0).to_numpy(zero_copy_only=False), b.column(1).to_pylist()
                for lo, hi in blocks(texts):
                    token, context, doc = windows(texts[lo:hi])
                    at = targets(ids[lo:hi], doc, r, mask)
                    for i in range(0, len(at), BATCH):
                        x = at[i:i + BATCH]
                        own.learn(context[x], classes[token[x]], seen)
                    done += len(at)
            if done:
                yield _slices(np.concatenate((own.weights.astype(np.float64) * done, [float(done)])))

        total = _sum_slices(tokens.select("id", "tokens").mapInArrow(run, _SLICE_DDL), np.float64, tokens.rdd.getNumPartitions())
        if not len(total):
            break
        net = Network((total[:-1] / total[-1]).astype(np.float32))
    return net


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, mask: int = MASK) -> DataFrame:
    """(id, n_tokens, log_likelihood, mean_log_prob, unigram_log_likelihood)."""
    spark = docs.sparkSession
    table = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    table = materialize(table.mapInArrow(_tokens, "id long, tokens binary"), "lm-tokens")
    counts = token_counts(table)
    cls, inside, class_mass = classes_of(counts)
    net = train(table, cls, class_mass, rounds, mask)
    model = spark.sparkContext.broadcast((net.weights, cls, inside, np.log(class_mass / class_mass.sum())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, cls, inside, prior = model.value
        own = Network(weights)
        for b in batches:
            texts, parts = b.column(1).to_pylist(), []
            for lo, hi in blocks(texts):
                token, context, doc = windows(texts[lo:hi])
                logp = own.log_probs(context, cls[token]) + inside[token]
                # without a token bincount gives integers
                parts.append([np.bincount(doc, x, hi - lo).astype(kind) for x, kind in (
                    (None, np.int64), (logp, float), (prior[cls[token]] + inside[token], float))])
            n, total, single = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0),) * 3
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(total), pa.array(total / np.maximum(n, 1), mask=n == 0),
                                              pa.array(single)],
                                             names=["id", "n_tokens", "log_likelihood", "mean_log_prob", "unigram_log_likelihood"])

    return table.mapInArrow(run, "id long, n_tokens long, log_likelihood double, mean_log_prob double, unigram_log_likelihood double")
