"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a document's bytes, white space included, in both directions and gives every byte
position a distribution over the learned languages.  A document's distribution pools the
log-probabilities of all its positions.  It is trained in numpy by backpropagation through time on a
bounded sample of the learnable documents.

A text is read in stretches of ``STRETCH`` bytes, many at a time; the state runs through words and white
space, and enters a stretch and leaves it over ``AROUND`` more bytes on either side.  So a text of any
length costs tasks a few megabytes.  Equal stretches, as copies have them, are computed once while a
task remembers them (``REMEMBERED`` at most).  Documents are labelled in one pass, whole texts, no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


STRETCH, AROUND = 256, 12
HIDDEN = 8
#: Bounds of the training sample.
DOCS_PER_LANGUAGE, STRETCHES_PER_DOC = 250, 4
STEPS, BATCH, RATE = 160, 80, 0.015
#: Bytes that an error runs back through.
BACK = 128
REMEMBERED = 20_000
UNKNOWN = "und"
#: Log-probabilities are kept as multiples of this, so that sums don't depend on how stretches were batched.
GRAIN = 1 / 1024

LETTER = re.compile(r"[^\W\d_]")


def stretches(text: str) -> list[tuple[bytes, int, int]]:
    """The text's stretches, each as (bytes with those around it, start and end of its own among them)."""
    raw = text.encode("utf-8", "replace")
    out = []
    for k in range(0, len(raw), STRETCH):
        lo = max(0, k - AROUND)
        out.append((raw[lo:k + STRETCH + AROUND], k - lo, min(k + STRETCH, len(raw)) - lo))
    return out


def _arrays(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(byte matrix padded with 0, lengths)."""
    lengths = np.fromiter(map(len, runs), dtype=np.int64, count=len(runs))
    width = int(lengths.max(initial=1))
    flat = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in runs), dtype=np.uint8)
    return flat.reshape(len(runs), width), lengths


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Net:
    """Weights of both directions and of the output layer; float32 throughout."""

    NAMES = ("Wf", "Uf", "Vf", "Wb", "Ub", "Vb", "Of", "Ob", "o")

    def __init__(self, languages: list[str], seed: int = 7, hidden: int = HIDDEN):
        rng, h, n = np.random.default_rng(seed), hidden, len(languages)
        self.languages, self.hidden = languages, h

        def mat(*shape):
            return (rng.standard_normal(shape) / np.sqrt(shape[0] if len(shape) > 1 else 1)).astype(np.float32)

        # W: a byte's input to update gate, reset gate and candidate; U: from state to the gates; V: to the candidate
        self.p = {"o": np.zeros(n, np.float32), "Of": mat(h, n), "Ob": mat(h, n)}
        for d in "fb":
            self.p[f"W{d}"] = mat(256, 3 * h) * 4
            self.p[f"U{d}"], self.p[f"V{d}"] = mat(h, 2 * h), mat(h, h)

    def _pass(self, d: str, x: np.ndarray, lengths: np.ndarray, tape: list | None = None) -> np.ndarray:
        """States (rows, width, hidden) of one direction; rows must be sorted by descending length."""
        h, W, U, V = self.hidden, self.p[f"W{d}"], self.p[f"U{d}"], self.p[f"V{d}"]
        out = np.zeros((*x.shape, h), np.float32)
        state = np.zeros((len(x), h), np.float32)
        for t in range(x.shape[1]):
            n = int(np.searchsorted(-lengths, -t, side="left"))  # rows longer than t
            if not n:
                break
            old = state[:n]
            enter = W[x[:n, t]]
            gates = _sigmoid(enter[:, :2 * h] + old @ U)
            z, r = gates[:, :h], gates[:, h:]
            kept = r * old
            new = np.tanh(enter[:, 2 * h:] + kept @ V)
            state = state.copy() if tape is not None else state
            state[:n] = old + z * (new - old)
            out[:n, t] = state[:n]
            if tape is not None:
                tape.append((n, old.copy(), z, r, kept, new))
        return out

    @staticmethod
    def _reverse(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Each row's first ``length`` entries reversed."""
        at = lengths[:, None] - 1 - np.arange(x.shape[1])[None, :]
        rows = np.arange(len(x))[:, None]
        good = at >= 0
        return np.where(good[..., None] if x.ndim == 3 else good, x[rows, np.maximum(at, 0)], 0)

    def positions(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Log-probabilities (rows, width, languages) of every position; rows sorted by descending length."""
        f = self._pass("f", x, lengths)
        b = self._reverse(self._pass("b", self._reverse(x, lengths), lengths), lengths)
        z = f @ self.p["Of"] + b @ self.p["Ob"] + self.p["o"]
        z -= z.max(-1, keepdims=True)
        return z - np.log(np.exp(z).sum(-1, keepdims=True))

    def _walk(self, d: str, x: np.ndarray, live: list[int], steps: range) -> Iterator[tuple[int, np.ndarray]]:
        """(place, states) of the rows that reach it, for each place in turn; ``x`` has a row a place,
        states a column a text."""
        h = self.hidden
        W, U, V = self.p[f"W{d}"], np.ascontiguousarray(self.p[f"U{d}"].T), np.ascontiguousarray(self.p[f"V{d}"].T)
        # a byte's input as seen by exp(-gate)
        W = np.ascontiguousarray(W.T)
        W[:2 * h] *= -1
        U = -U
        state = np.zeros((h, x.shape[1]), np.float32)
        last, old, enter = -1, state, state
        for t in steps:
            n = live[t]
            if n != last:
                if old is not state:
                    state[:, :old.shape[1]] = old
                old = state if n == x.shape[1] else np.ascontiguousarray(state[:, :n])
                enter, last = np.empty((3 * h, n), np.float32), n
            np.take(W, x[t, :n], axis=1, out=enter, mode="clip")
            gates = U @ old
            gates += enter[:2 * h]
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            new = gates[h:]
            new *= old
            new = V @ new
            new += enter[2 * h:]
            np.tanh(new, out=new)
            new -= old
            new *= gates[:h]
            old += new
            yield t, old

    def pooled(self, runs: list[tuple[bytes, int, int]]) -> np.ndarray:
        """Sum of the log-probabilities of a stretch's own positions, in grains."""
        lengths = np.fromiter((len(r[0]) for r in runs), dtype=np.int64, count=len(runs))
        order = np.argsort(-lengths, kind="stable")
        out = np.zeros((len(runs), len(self.languages)), np.int64)
        Of, Ob, o = np.ascontiguousarray(self.p["Of"].T), np.ascontiguousarray(self.p["Ob"].T), self.p["o"][:, None]
        for part in np.array_split(order, -(-len(order) // 1024)):
            x, n = _arrays([runs[k][0] for k in part])
            x = np.ascontiguousarray(x.T).astype(np.intp)
            live = [int(np.searchsorted(-n, -t, side="left")) for t in range(len(x))]
            lo, hi = (np.array([runs[k][j] for k in part]) for j in (1, 2))
            z = np.zeros((len(x), len(o), x.shape[1]), np.float32)
            z += o
            for t, state in self._walk("f", x, live, range(len(x))):
                z[t, :, :live[t]] += Of @ state
            for t, state in self._walk("b", x, live, range(len(x) - 1, -1, -1)):
                z[t, :, :live[t]] += Ob @ state
            z -= z.max(1, keepdims=True)
            z -= np.log(np.exp(z).sum(1, keepdims=True))
            at = np.arange(len(x))[:, None]
            z *= ((lo <= at) & (at < hi))[:, None]
            out[part] = np.rint(z.sum(0, dtype=np.float64).T / GRAIN).astype(np.int64)
        return out

    def step(self, x: np.ndarray, lengths: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy of all positions and its gradients, by backpropagation through time."""
        p, tapes = self.p, {"f": [], "b": []}
        f = self._pass("f", x, lengths, tapes["f"])
        back = self._reverse(x, lengths)
        b = self._reverse(self._pass("b", back, lengths, tapes["b"]), lengths)
        z = f @ p["Of"] + b @ p["Ob"] + p["o"]
        z -= z.max(-1, keepdims=True)
        prob = np.exp(z)
        prob /= prob.sum(-1, keepdims=True)
        real = np.arange(x.shape[1])[None, :] < lengths[:, None]
        count = real.sum()
        rows = np.arange(len(x))
        loss = -np.log(prob[rows, :, label] + 1e-9)[real].mean()
        dz = prob
        dz[rows, :, label] -= 1
        dz *= real[..., None] / np.float32(count)
        g = {"o": dz.sum((0, 1)), "Of": np.einsum("bth,btl->hl", f, dz, optimize=True),
             "Ob": np.einsum("bth,btl->hl", b, dz, optimize=True)}
        self._back("f", x, tapes["f"], dz @ p["Of"].T, g)
        self._back("b", back, tapes["b"], self._reverse(dz @ p["Ob"].T, lengths), g)
        return float(loss), g

    def _back(self, d: str, x: np.ndarray, tape: list, dout: np.ndarray, g: dict) -> None:
        h, U, V = self.hidden, self.p[f"U{d}"], self.p[f"V{d}"]
        gU, gV = np.zeros_like(U), np.zeros_like(V)
        read, felt = [], []
        dstate = np.zeros((len(x), h), np.float32)
        for t in range(len(tape) - 1, -1, -1):
            n, old, z, r, kept, new = tape[t]
            ds = dstate[:n] + dout[:n, t]
            dnew = ds * z * (1 - new * new)
            dkept = dnew @ V.T
            dz = ds * (new - old) * z * (1 - z)
            dr = dkept * old * r * (1 - r)
            dgates = np.hstack([dz, dr])
            dstate[:n] = ds * (1 - z) + dkept * r + dgates @ U.T
            gV += kept.T @ dnew
            gU += old.T @ dgates
            read.append(x[:n, t])
            felt.append(np.hstack([dgates, dnew]))
        each, felt = np.concatenate(read), np.concatenate(felt).T
        gW = np.stack([np.bincount(each, f, 256) for f in felt], 1).astype(self.p[f"W{d}"].dtype)
        g[f"W{d}"], g[f"U{d}"], g[f"V{d}"] = gW, gU, gV


def train(runs: list[bytes], labels: np.ndarray, languages: list[str], steps: int = STEPS, seed: int = 7) -> Net:
    """Adam over random batches; deterministic for given rows and seed."""
    net, rng = Net(languages, seed), np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(w) for k, w in net.p.items()}
    by = [np.flatnonzero(labels == k) for k in range(len(languages))]
    by = [b for b in by if len(b)]
    for t in range(1, steps + 1):
        pick = np.concatenate([rng.choice(b, max(1, BATCH // len(by))) for b in by])
        pick = pick[np.argsort([-len(runs[k]) for k in pick], kind="stable")]
        x, n = _arrays([runs[k] for k in pick])
        _, g = net.step(x, n, labels[pick])
        rate = RATE * min(1.0, 2 * (1 - t / (steps + 1)))
        for k, w in net.p.items():
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
            w -= (rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.99 ** t)) + 1e-8)).astype(np.float32)
    return net


def held_out(id_col: Column) -> Column:
    """Documents that nothing may be learned from; a null id is learnable."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> list[tuple[str, list[bytes]]]:
    """(language, stretches) of the first ``DOCS_PER_LANGUAGE`` learnable documents of each language by
    the hash of their id.  The table is read twice: to count, and for the documents below a bound on
    the hash that their language's count gives; each task hands on its first ones."""
    near = F.pmod(F.xxhash64("h"), F.lit(2**30))
    can = docs.where(~held_out(F.col(id_col)) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(id_col).cast("string").alias("h"), F.col(text_col).cast("string").alias("t"))
    counts = {r["lang"]: r["count"] for r in can.groupBy("lang").count().collect()}
    if not counts:
        return []
    # enough rows lie below the bound in all but very rare cases; a language with few is taken whole
    bound = {k: 2**30 if n <= 4 * DOCS_PER_LANGUAGE else int(2**30 * 1.5 * DOCS_PER_LANGUAGE / n) + 1 for k, n in counts.items()}
    bounds = F.create_map(*(F.lit(x) for pair in bound.items() for x in pair))

    def first(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["near", "h", "t"], na_position="first")
        return rows.groupby("lang", sort=False).head(DOCS_PER_LANGUAGE)

    def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            texts = []
            for text in batch["t"]:
                got = [r[0] for r in stretches(text) if LETTER.search(r[0].decode("utf-8", "ignore"))]
                texts.append(b"".join(r[:STRETCH].ljust(STRETCH, b"\0") for r in got[::-(-len(got) // STRETCHES_PER_DOC)]) if got else b"")
            batch = batch.assign(t=texts)
            held = first(batch if held is None else pd.concat([held, batch]))
        if held is not None:
            yield held

    kind = "lang string, near long, h string, t binary"
    rows = can.select("lang", near.alias("near"), "h", "t").where(F.col("near") < bounds[F.col("lang")]).mapInPandas(own, kind)
    rows = rows.groupBy("lang").applyInPandas(first, kind).collect()
    rows.sort(key=lambda r: (r.lang, r.near, r.h or "", bytes(r.t)))
    return [(r.lang, [bytes(r.t[k:k + STRETCH]).rstrip(b"\0") for k in range(0, len(r.t), STRETCH)]) for r in rows]


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Net | None:
    """Learn from a bounded sample of the learnable documents, evenly spread stretches of each.  None if
    there is nothing to learn from."""
    rows = sample(docs, id_col, text_col, lang_col)
    languages = sorted({lang for lang, _ in rows})
    cut = [(lang, r[k:k + BACK]) for lang, own in rows for r in own for k in range(0, len(r), BACK)]
    runs, labels = [r for _, r in cut], [languages.index(lang) for lang, _ in cut]
    return train(runs, np.array(labels), languages) if runs else None


def _judge(net: Net, texts: pd.Series, memory: dict[tuple[bytes, int, int], int], table: list[np.ndarray]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text; ``memory`` has the row in ``table`` of stretches seen before."""
    lists = [stretches(t) if isinstance(t, str) and LETTER.search(t) else [] for t in texts]
    if len(memory) > REMEMBERED:
        memory.clear()
        table[0] = table[0][:0]
    new = list(dict.fromkeys(r for runs in lists for r in runs if r not in memory))
    if new:
        for k, r in enumerate(new, len(memory)):
            memory[r] = k
        table[0] = np.concatenate([table[0], net.pooled(new)])
    names, scores = [], np.zeros(len(lists))
    for k, runs in enumerate(lists):
        if not runs:
            names.append(UNKNOWN)
            continue
        total = table[0][np.fromiter(map(memory.__getitem__, runs), np.int64, len(runs))].sum(0) * GRAIN
        best = int(total.argmax())
        names.append(net.languages[best])
        scores[k] = 1 / np.exp(total - total[best]).sum()
    return names, scores


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score), one row per row of ``docs``.

    ``lang_pred`` is a learned language, or ``und`` with score 0 for a null text, a text without a
    letter, or if there was nothing to learn from.  Of languages with the same probability the first by name
    is taken.  Repeated rows are judged each and alike, texts whole however long; an empty table gives no
    rows, and further columns of any name are not read."""
    net = fit(docs, id_col, text_col, lang_col)

    @F.pandas_udf("struct<lang_pred string, score double>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        memory: dict[tuple[bytes, int, int], int] = {}
        table = [np.zeros((0, len(net.languages) if net else 0), np.int64)]
        for texts in batches:
            if net is None:
                names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            else:
                names, scores = _judge(net, texts, memory, table)
            yield pd.DataFrame({"lang_pred": names, "score": np.round(scores, 6)})

    rows = docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), predict(F.col(text_col).cast("string")).alias("p"))
    return rows.select(id_col, "held_out", "p.lang_pred", "p.score")


def label_positions(net: Net, text: str) -> list[str]:
    """The language of every byte of a text."""
    out: list[str] = []
    for raw, lo, hi in stretches(text):
        x, n = _arrays([raw])
        out += [net.languages[k] for k in net.positions(x, n)[0, lo:hi].argmax(-1)]
    return out
