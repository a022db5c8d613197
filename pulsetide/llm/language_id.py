"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a text in segments, forwards and backwards, and gives every byte the
probabilities of the languages; a document's are the mean over all its bytes. It is trained in
numpy by backpropagation through time, on the driver, on a sample whose size is bounded by
parameters; prediction runs over whole texts where their rows are.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetide.llm.common import blocks, ragged, returning, table, text_buffers

#: Bounds of the training sample: documents of a language that are expected (twice as many at
#: most), pieces of a document, bytes of a piece. Every language is learned.
DOCUMENTS, PIECES, PIECE = 300, 16, 48

#: Pieces in a training step, learning rate, and what states and steps follow the number of
#: languages from: for up to eight languages, and for each further eight as many steps more.
BATCH, RATE = 192, 0.02
HIDDEN, STEPS, EACH = 8, 250, 8

#: Bytes of a segment in prediction, and segments run side by side.
SEGMENT, LANES = 128, 2048

#: The code of a place without a byte.
PAD = 256

UNDETERMINED = "und"

#: Codes of bytes: upper-case ASCII letters are read as lower-case ones.
_CODES = np.arange(256, dtype=np.int16)
_CODES[65:91] += 32


@dataclass
class Direction:
    """Weights of one direction; gates in the order update, reset, candidate.

    ``inputs`` has what each byte adds to the gates (its embedding, already multiplied). The
    gates are halved logistic functions, 0.5 + 0.5 * tanh, so one call serves both.
    """

    inputs: np.ndarray  # 3 * hidden x 257
    state: np.ndarray  # 3 * hidden x hidden

    def run(self, codes: np.ndarray, training: bool) -> tuple[np.ndarray, list]:
        """States after each byte, for codes of (time, lanes), and what training needs."""
        hidden = self.state.shape[1]
        states = np.zeros((len(codes) + 1, hidden, codes.shape[1]), np.float32)
        trace = []
        for time, column in enumerate(codes):
            before = states[time]
            added = np.take(self.inputs, column, axis=1)
            own = self.state @ before
            gates = np.tanh(added[: 2 * hidden] + own[: 2 * hidden])
            gates *= 0.5
            gates += 0.5
            update, reset = gates[:hidden], gates[hidden:]
            candidate = np.tanh(added[2 * hidden :] + reset * own[2 * hidden :])
            states[time + 1] = candidate + update * (before - candidate)
            if training:
                trace.append((gates, candidate, own[2 * hidden :]))
        return states, trace

    def back(self, codes, states, trace, wanted) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of ``inputs`` and ``state`` from those of the states after each byte."""
        hidden, lanes = self.state.shape[1], codes.shape[1]
        d_gates = np.zeros((len(codes), 3 * hidden, lanes), np.float32)
        d_state = np.zeros_like(self.state)
        carried = np.zeros((hidden, lanes), np.float32)
        for time in range(len(codes) - 1, -1, -1):
            before, (gates, candidate, own) = states[time], trace[time]
            update, reset = gates[:hidden], gates[hidden:]
            d_after = wanted[time] + carried
            d_candidate = d_after * (1 - update) * (1 - candidate**2)
            d_own = d_candidate * reset
            d = d_gates[time]
            d[:hidden] = d_after * (before - candidate) * 2 * update * (1 - update)
            d[hidden : 2 * hidden] = d_candidate * own * 2 * reset * (1 - reset)
            d[2 * hidden :] = d_candidate
            through = np.concatenate([d[: 2 * hidden], d_own])
            carried = d_after * update + self.state.T @ through
            d_state += through @ before.T
        d_inputs = np.zeros_like(self.inputs)
        flat = d_gates.transpose(0, 2, 1).reshape(-1, 3 * hidden)
        np.add.at(d_inputs.T, codes.reshape(-1), flat)
        return d_inputs, d_state


@dataclass
class Network:
    """Both directions, and the layer from their states to the languages."""

    languages: list[str]
    forward: Direction
    backward: Direction
    out: np.ndarray  # languages x (2 * hidden + 1), the last column a constant

    @classmethod
    def fresh(cls, languages: list[str], hidden: int, seed: int = 0) -> "Network":
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
        sides = [Direction(draw(3 * hidden, 257), draw(3 * hidden, hidden)) for _ in range(2)]
        for side in sides:
            side.inputs[:, PAD] = 0
            side.inputs[:hidden, PAD] = 30  # the update gate is open: the state stays
        return cls(languages, *sides, draw(len(languages), 2 * hidden + 1))

    def parameters(self) -> list[np.ndarray]:
        return [self.forward.inputs, self.forward.state, self.backward.inputs, self.backward.state, self.out]

    def positions(self, codes: np.ndarray, training: bool = False) -> tuple[np.ndarray, tuple]:
        """Probabilities (time, language, lane) of every place, and what training needs."""
        ahead, trace_a = self.forward.run(codes, training)
        behind, trace_b = self.backward.run(codes[::-1], training)
        hidden = self.forward.state.shape[1]
        seen, coming = ahead[1:], behind[:0:-1]
        values = self.out[:, :hidden] @ seen + self.out[:, hidden:-1] @ coming + self.out[:, -1:]
        values -= values.max(axis=1, keepdims=True)
        np.exp(values, out=values)
        values /= values.sum(axis=1, keepdims=True)
        return values, (ahead, trace_a, behind, trace_b)

    def gradients(self, codes: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross-entropy of all places with a byte, each labelled as its text."""
        found, (ahead, trace_a, behind, trace_b) = self.positions(codes, training=True)
        hidden = self.forward.state.shape[1]
        error = found
        error[:, labels, np.arange(codes.shape[1])] -= 1
        there = codes != PAD
        error *= (there / max(there.sum(), 1)).astype(np.float32)[:, None, :]
        seen, coming = ahead[1:], behind[:0:-1]
        d_out = np.zeros_like(self.out)
        d_out[:, :hidden] = np.tensordot(error, seen, ([0, 2], [0, 2]))
        d_out[:, hidden:-1] = np.tensordot(error, coming, ([0, 2], [0, 2]))
        d_out[:, -1] = error.sum(axis=(0, 2))
        to_seen = self.out[:, :hidden].T @ error
        to_coming = (self.out[:, hidden:-1].T @ error)[::-1]
        a = self.forward.back(codes, ahead, trace_a, to_seen)
        b = self.backward.back(codes[::-1], behind, trace_b, to_coming)
        return [*a, *b, d_out]

    def train(self, codes: np.ndarray, labels: np.ndarray, steps: int, batch: int, rate: float, seed: int = 0) -> None:
        """Adam over random batches; languages are drawn equally often."""
        rng = np.random.default_rng(seed)
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self.parameters()]
        by_label = [np.flatnonzero(labels == k) for k in range(len(self.languages))]
        for step in range(1, steps + 1):
            drawn = rng.integers(len(by_label), size=batch)
            rows = np.array([rng.choice(by_label[k]) for k in drawn])
            scale = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for parameter, gradient, (m, v) in zip(
                self.parameters(), self.gradients(codes[rows].T, labels[rows]), moments
            ):
                if gradient.shape[1] == 257:
                    gradient[:, PAD] = 0
                m += 0.1 * (gradient - m)
                v += 0.001 * (gradient**2 - v)
                parameter -= scale * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def documents(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean probabilities over all bytes of each text; zeros for an empty one."""
        lengths = np.diff(offsets)
        parts = -(-lengths // SEGMENT)
        first = np.cumsum(parts) - parts
        codes = np.full((int(parts.sum()), SEGMENT), PAD, np.int16)
        codes.reshape(-1)[ragged(first * SEGMENT, lengths)] = _CODES[raw]
        sums = np.zeros((len(codes), len(self.languages)))
        for at in range(0, len(codes), LANES):
            some = codes[at : at + LANES]
            found, _ = self.positions(np.ascontiguousarray(some.T))
            found *= (some.T != PAD)[:, None, :]
            sums[at : at + LANES] = found.sum(axis=0).T
        totals = np.zeros((len(lengths), len(self.languages)))
        np.add.at(totals, np.repeat(np.arange(len(lengths)), parts), sums)
        return totals / np.maximum(lengths, 1)[:, None]


def is_held_out(id_column: str) -> F.Column:
    """Whether the checksum of the id's text is 2 modulo 4; a null id's text is empty."""
    return F.crc32(F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit(""))) % 4 == 2


def has_letter(texts: pa.Array) -> pa.Array:
    return pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces spread evenly over each text, the last byte included."""
    for batch in batches:
        batch = batch.filter(has_letter(batch.column("text")))
        langs, pieces = [], []
        for lang, text in zip(*[batch.column(c).to_pylist() for c in ("lang", "text")]):
            whole = text.encode()
            last = max(len(whole) - PIECE, 0)
            count = min(PIECES, 1 + last // PIECE)
            for at in np.linspace(0, last, count).astype(int):
                langs.append(lang)
                pieces.append(whole[at : at + PIECE])
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(pieces, pa.binary())], ["lang", "piece"]
        )


def sizes(languages: int) -> tuple[int, int]:
    """States of a direction and training steps for so many languages."""
    eights = -(-languages // EACH)
    return HIDDEN * max(1, math.ceil(math.log2(max(languages, 2)) / 3)), STEPS * eights


def learn(labelled: DataFrame, hidden: int | None = None, steps: int | None = None) -> Network | None:
    """A network for the languages of ``labelled`` (``doc_id, text, lang``); None without any.

    All languages are learned, however rare; the network and its training grow with their
    number (``sizes``) unless ``hidden`` and ``steps`` say otherwise. The sample is drawn by a hash of the id, so it does not depend on how rows are stored.
    """
    labelled = labelled.filter("lang IS NOT NULL AND text IS NOT NULL")
    counts = labelled.groupBy("lang").count().collect()
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for row in counts for x in (row["lang"], DOCUMENTS / row["count"])])
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    drawn = labelled.filter(place < share[F.col("lang")]).limit(2 * DOCUMENTS * len(counts))
    rows = drawn.select("lang", "text").mapInArrow(returning(_pieces), "lang string, piece binary").collect()
    rows = sorted((row.lang, bytes(row.piece)) for row in rows)
    if not rows:
        return None
    languages = sorted({lang for lang, _ in rows})
    codes = np.full((len(rows), PIECE), PAD, np.int16)
    for i, (_, piece) in enumerate(rows):
        codes[i, : len(piece)] = _CODES[np.frombuffer(piece, np.uint8)]
    labels = np.array([languages.index(lang) for lang, _ in rows])
    states, rounds = sizes(len(languages))
    network = Network.fresh(languages, hidden or states)
    network.train(codes, labels, steps or rounds, BATCH, RATE)
    return network


def identify(docs: DataFrame, network: Network | None, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``lang_pred`` and ``score``, the language's mean probability.

    * A text that is null or has no letter is ``und`` with score 0, as is any without a network.
    * Of equally probable languages the first by name is taken. Texts may be of any length;
      rows may repeat; columns named like the result are replaced; an empty table stays empty.
    """
    made = ("lang_pred", "score")
    kept = [c for c in docs.columns if c not in made]
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column(text)
            raw, offsets = text_buffers(texts)
            letters = has_letter(texts).to_numpy(zero_copy_only=False)
            names, scores = [], []
            for first, last in blocks(offsets) if model else []:
                found = model.documents(raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
                names += [model.languages[k] for k in found.argmax(axis=1)]
                scores += found.max(axis=1).tolist()
            if model is None:
                names, scores, letters = [UNDETERMINED] * len(texts), [0.0] * len(texts), ~letters & False
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in kept],
                    pa.array([n if ok else UNDETERMINED for n, ok in zip(names, letters)], pa.string()),
                    pa.array([min(max(s, 0.0), 1.0) if ok else 0.0 for s, ok in zip(scores, letters)], pa.float64()),
                ],
                [*kept, *made],
            )

    schema = docs.select(*[f"`{c}`" for c in kept]).schema.add("lang_pred", "string").add("score", "double")
    return docs.mapInArrow(returning(run), schema)


def op5_language_id(spark, sf_dir):
    """Languages of the whole of ``documents``, learned from those not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    network = learn(docs.filter(~is_held_out("doc_id")))
    asked = docs.select("doc_id", is_held_out("doc_id").alias("held_out"), "text")
    return identify(asked, network).select("doc_id", "held_out", "lang_pred", "score")
