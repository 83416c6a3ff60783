"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads windows of 64 bytes from both sides, labels every position,
and the position probabilities are averaged over the whole document. It is
trained in numpy by backpropagation through time on a bounded sample of
labelled windows, then applied to every byte of every document in Arrow
batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from outletlab.llm.common import text_blocks

WINDOW = 64  # bytes the network reads at once
HIDDEN = 8
WINDOWS_PER_LANGUAGE = 3_000  # bound of the training sample
STEPS = 500
BATCH = 192
PAD = 256
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Model:
    """Weights of one direction: inputs (3H x 257, bias included), recurrent
    (3H x H), and the output layer over both directions."""
    languages: list[str]
    inputs: list[np.ndarray]
    recurrent: list[np.ndarray]
    output: np.ndarray
    bias: np.ndarray


def held_out(id_column: Column) -> Column:
    return F.crc32(id_column.cast("string").cast("binary")) % 4 == 2


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes as WINDOW x windows with PAD at the ends of rows, and each window's row."""
    sizes = np.diff(offsets)
    count = -(-sizes // WINDOW)
    row = np.repeat(np.arange(len(sizes)), count)
    nth = np.arange(len(row)) - (np.cumsum(count) - count)[row]
    start = offsets[row] + nth * WINDOW
    at = start[None, :] + np.arange(WINDOW)[:, None]
    inside = at < offsets[row + 1][None, :]
    return np.where(inside, data[np.minimum(at, max(len(data) - 1, 0))].astype(np.int16), np.int16(PAD)), row


def _scan(x: np.ndarray, w: np.ndarray, u: np.ndarray, reverse: bool, keep: bool):
    """States (WINDOW, H, lanes) of one direction; with ``keep`` also the gates.
    Sigmoids are computed as (1 + tanh) / 2, the halves folded into weights."""
    h = u.shape[1]
    lanes = x.shape[1]
    states = np.zeros((WINDOW, h, lanes), np.float32)
    gates = np.zeros((WINDOW, 3 * h, lanes), np.float32) if keep else None
    state = np.zeros((h, lanes), np.float32)
    for t in range(WINDOW - 1, -1, -1) if reverse else range(WINDOW):
        g = np.take(w, x[t], axis=1)
        r = u @ state
        a = g[: 2 * h]
        a += r[: 2 * h]
        a *= 0.5
        np.tanh(a, out=a)
        a *= 0.5
        a += 0.5
        c = g[2 * h:]
        r2 = r[2 * h:]
        if keep:
            gates[t, : 2 * h] = a
        c += a[h:] * r2
        np.tanh(c, out=c)
        if keep:
            gates[t, 2 * h:] = c
        state = c + a[:h] * (state - c)
        states[t] = state
    return states, gates


def _probabilities(model: Model, states: list[np.ndarray]) -> np.ndarray:
    """(languages, WINDOW, lanes) label probabilities of every position."""
    h = states[0].shape[1]
    out = model.output
    score = np.einsum("kh,thl->ktl", out[:, :h], states[0], optimize=True)
    score += np.einsum("kh,thl->ktl", out[:, h:], states[1], optimize=True)
    score += model.bias[:, None, None]
    score -= score.max(axis=0)
    np.exp(score, out=score)
    score /= score.sum(axis=0)
    return score


def train(texts: list[bytes], labels: list[str], seed: int = 7) -> Model | None:
    """Fit by backpropagation through time with Adam; None without labels."""
    languages = sorted(set(labels))
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    data = np.frombuffer(b"".join(t[:WINDOW] for t in texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([min(len(t), WINDOW) for t in texts])]).astype(np.int64)
    x, row = windows(data, offsets)
    y = np.array([languages.index(lang) for lang in labels])[row]
    k, h = len(languages), HIDDEN
    shape = {"w0": (3 * h, 257), "w1": (3 * h, 257), "u0": (3 * h, h), "u1": (3 * h, h), "o": (k, 2 * h), "b": (k,)}
    p = {n: (rng.standard_normal(s) * (0.3 if n[0] != "b" else 0)).astype(np.float32) for n, s in shape.items()}
    moments = {n: (np.zeros(s, np.float32), np.zeros(s, np.float32)) for n, s in shape.items()}
    for step in range(1, STEPS + 1):
        pick = rng.integers(0, x.shape[1], BATCH)
        xb, yb = x[:, pick], y[pick]
        weight = (xb != PAD).astype(np.float32)
        weight /= weight.sum()
        model = Model(languages, [p["w0"], p["w1"]], [p["u0"], p["u1"]], p["o"], p["b"])
        runs = [_scan(xb, p[f"w{d}"], p[f"u{d}"], d == 1, True) for d in (0, 1)]
        prob = _probabilities(model, [r[0] for r in runs])
        prob[yb, :, np.arange(BATCH)] -= 1
        delta = prob * weight[None]
        grad = {"b": delta.sum(axis=(1, 2)), "o": np.zeros(shape["o"], np.float32)}
        for d, (states, gates) in enumerate(runs):
            own = slice(d * h, (d + 1) * h)
            grad["o"][:, own] = np.einsum("ktl,thl->kh", delta, states, optimize=True)
            down = np.einsum("kh,ktl->thl", p["o"][:, own], delta, optimize=True)
            gw, gu = np.zeros(shape["w0"], np.float32), np.zeros(shape["u0"], np.float32)
            back = np.zeros((h, BATCH), np.float32)
            u = p[f"u{d}"]
            for t in range(WINDOW) if d else range(WINDOW - 1, -1, -1):
                before = t + 1 if d else t - 1
                prev = states[before] if 0 <= before < WINDOW else np.zeros((h, BATCH), np.float32)
                z, r, c = gates[t, :h], gates[t, h: 2 * h], gates[t, 2 * h:]
                dh = back + down[t]
                dc = dh * (1 - z) * (1 - c * c)
                mixed = u[2 * h:] @ prev
                dz = dh * (prev - c) * z * (1 - z)
                dr = dc * mixed * r * (1 - r)
                flat = np.concatenate([dz, dr, dc])
                through = np.concatenate([dz, dr, dc * r])
                np.add.at(gw.T, xb[t], flat.T)
                gu += through @ prev.T
                back = dh * z + u.T @ through
            grad[f"w{d}"], grad[f"u{d}"] = gw, gu
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        rate = 0.02 * min(1.0, 2 * (1 - step / STEPS) + 0.05)
        for n, g in grad.items():
            g = g * min(1.0, 1.0 / max(norm, 1e-9))
            m, v = moments[n]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p[n] = p[n] - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
            p[n] = p[n].astype(np.float32)
    return Model(languages, [p["w0"], p["w1"]], [p["u0"], p["u1"]], p["o"], p["b"])


def document_probabilities(model: Model, data: np.ndarray, offsets: np.ndarray, lanes: int = 2048) -> np.ndarray:
    """Mean position probabilities (rows x languages) over whole rows."""
    x, row = windows(data, offsets)
    total = np.zeros((len(offsets) - 1, len(model.languages)))
    for lo in range(0, x.shape[1], lanes):
        xb = x[:, lo: lo + lanes]
        states = [_scan(xb, model.inputs[d], model.recurrent[d], d == 1, False)[0] for d in (0, 1)]
        prob = _probabilities(model, states)
        prob *= xb != PAD
        np.add.at(total, row[lo: lo + lanes], prob.sum(axis=1).T)
    return total / np.maximum(np.diff(offsets), 1)[:, None]


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Train on at most about WINDOWS_PER_LANGUAGE windows of each language.

    Documents are counted by language, a share of each language is chosen by
    a hash of the id, and of each chosen document come up to eight windows at
    hashed places; the sample's size doesn't grow with the input.
    """
    rows = labelled.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.filter("lang IS NOT NULL AND length(text) > 0")
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    docs_wanted = WINDOWS_PER_LANGUAGE // 4
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, docs_wanted / n))])
    chosen = rows.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.element_at(share, F.col("lang")) * (1 << 30))
    place = F.lit(1) + F.pmod(F.xxhash64("id", "k"), F.greatest(F.length("text") - WINDOW, F.lit(1))).cast("int")
    sample = (chosen.withColumn("k", F.explode(F.sequence(F.lit(1), F.least(F.lit(8), F.ceil(F.length("text") / WINDOW).cast("int")))))
              .select("id", "k", "lang", F.substring("text", place, F.lit(WINDOW)).alias("text"))
              .limit(8 * WINDOWS_PER_LANGUAGE * len(counts)).collect())
    sample.sort(key=lambda r: (r.id, r.k))
    return train([r.text.encode() for r in sample], [r.lang for r in sample])


def label_languages(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row of ``docs``.

    lang_pred is the language with the largest mean probability over the
    positions of the whole text and score that mean. A text that is null or
    has no letter, or a missing model, gives ``und`` and 0. Ties go to the
    first language in order. Null ids and repeated rows are labelled like any
    other row; other columns are not read.
    """
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for lo, hi, data, offsets in text_blocks(batch.column(1)):
                texts = batch.column(1).slice(lo, hi - lo)
                known = [bool(model) and LETTER.search(t.as_py() or "") is not None for t in texts]
                names, scores = [UNKNOWN] * (hi - lo), np.zeros(hi - lo)
                if any(known):
                    prob = document_probabilities(model, data, offsets)
                    names = [model.languages[i] if k else UNKNOWN for i, k in zip(prob.argmax(axis=1), known, strict=True)]
                    scores = np.where(known, np.clip(prob.max(axis=1), 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(names, pa.string()), pa.array(scores)],
                                                 names=["id", "lang_pred", "score"])

    schema = StructType([StructField(id_col, docs.schema[id_col].dataType), StructField("lang_pred", StringType()),
                         StructField("score", DoubleType())])
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(batches, schema)
