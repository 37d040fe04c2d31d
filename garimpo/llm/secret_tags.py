"""Secrets in texts: fixed patterns, and a linear-chain conditional random field for the rest.

The field tags tokens as secret begin, inside or outside.  Its features are the
token's shape, its word and its neighbours' words and shapes, and the shape of the whole file.
It learns from what the patterns find in a bounded sample, and from copies of it in which values
and the words that announce them are replaced by others, so that shapes and neighbours must carry the
tags and values behind words the patterns do not spell out are named, too.  Decoding is Viterbi's; a token whose outside
score beats the others by more than any transition can give back is outside on the
best path, so only the stretches between such tokens are searched.
"""

from __future__ import annotations

import hashlib
import random
import re
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Words, slices

#: The three patterns, fixed values.
ASSIGN = re.compile(r"""(?a:(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{32}")
KINDS = ("assign", "access", "hex", "tagged")
CUES = ("password", "passwd", "secret", "token", "apikey", "api_key")

TOKEN = np.ones(256, dtype=bool)
TOKEN[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_.-", *range(128, 256)]] = False
OUT, BEGIN, INSIDE = 0, 1, 2
WORDS, SHAPES = 4096, 1024
PARTS = {"mix": 64, "shape": SHAPES, "word": WORDS, "before": WORDS, "before2": WORDS, "after": WORDS,
         "shape_before": SHAPES, "shape_after": SHAPES, "file": 512}


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the value) of the patterns' matches, sorted."""
    found = []
    low = text.lower()
    if any(cue in low for cue in CUES):
        found += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    if LONG_HEX.search(text):
        found += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text) if m.end() - m.start() >= 32]
    return sorted(found)


class Tokens:
    """Tokens of several texts with their feature indices: an array of tokens by features."""

    def __init__(self, texts: list[bytes]):
        found = Words(texts, TOKEN)
        self.start, self.end, self.text = found.start, found.end, found.text
        self.first = found.first
        data, n = found.data, len(found.start)
        size = self.end - self.start

        def share(low: int, high: int) -> np.ndarray:
            total = np.r_[0, np.cumsum((data >= low) & (data <= high), dtype=np.int32)]
            return total[self.end] - total[self.start]

        digits, upper, lower, other = share(48, 57), share(65, 90), share(97, 122), share(128, 255)
        hexes = digits + share(97, 102)
        marks = size - digits - upper - lower - other
        length = np.searchsorted([3, 5, 8, 12, 16, 24, 32], size, side="right")
        mixed_ = np.searchsorted([0.001, 0.15, 0.5, 0.999], digits / np.maximum(size, 1), side="right")
        shape = length
        for flag in (upper > 0, lower > 0, hexes == size, (marks > 0) | (other > 0)):
            shape = shape * 2 + flag
        shape = shape * 8 + mixed_
        kinds = (digits > 0) * 1 + (upper > 0) * 2 + (lower > 0) * 4 + (marks > 0) * 8 + (other > 0) * 16
        mix = kinds * 2 + (size > 11)
        word = ((found.hash >> np.uint64(20)) % np.uint64(WORDS)).astype(np.int64)
        count = np.bincount(self.text, minlength=len(texts))
        plain = np.bincount(self.text, (digits == 0) & (marks == 0), len(texts)) / np.maximum(count, 1)
        mean = np.bincount(self.text, size, len(texts)) / np.maximum(count, 1)
        files = np.searchsorted([0.5, 0.8, 0.95], plain) * 4 + np.searchsorted([4, 7, 12], mean)

        def near(values: np.ndarray, step: int) -> np.ndarray:
            """Values ``step`` tokens away in the same text, 0 beyond its ends."""
            out = np.zeros(n, dtype=np.int64)
            if n > abs(step):
                a, b = (slice(None, -step), slice(step, None)) if step > 0 else (slice(-step, None), slice(None, step))
                same = self.text[a] == self.text[b]
                out[a] = np.where(same, values[b], 0)
            return out

        columns = {
            "mix": mix, "shape": shape, "word": word, "before": near(word, -1), "before2": near(word, -2), "after": near(word, 1),
            "shape_before": near(shape, -1), "shape_after": near(shape, 1), "file": files[self.text] * 32 + length * 4 + (mixed_ > 1),
        }
        base, self.features = 0, np.empty((n, len(PARTS)), dtype=np.int32)
        for k, (name, width) in enumerate(PARTS.items()):
            self.features[:, k] = columns[name] + base
            base += width


class Field:
    """Weights of the chain: features by tags, transitions, first and last tags."""

    def __init__(self):
        self.emit = np.zeros((sum(PARTS.values()), 3))
        self.turn, self.first, self.last = np.zeros((3, 3)), np.zeros(3), np.zeros(3)

    def scores(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros((len(features), 3))
        for k in range(features.shape[1]):
            out += self.emit[features[:, k]]
        return out

    def train(
        self, chains: list[tuple[np.ndarray, np.ndarray]], rounds: int = 60, rate: float = 0.2, ridge: float = 1e-4, cells: int = 2**17
    ):
        """Maximum likelihood by Adam over all chains (features, tags).

        Chains of like length go together, about ``cells`` places at a time, so that memory is bounded
        whatever the sample; a round's slope is the sum over all of them.
        """
        chains = sorted((c for c in chains if len(c[1])), key=lambda c: len(c[1]))
        if not chains:
            self.first[BEGIN] = self.first[INSIDE] = self.turn[:, 1:] = -10.0
            return self
        groups, held = [[]], 0
        for c in chains:
            if held and held + len(c[1]) > cells:
                groups.append([])
                held = 0
            groups[-1].append(c)
            held += len(c[1])
        names = ("emit", "turn", "first", "last")
        moments: dict[str, list] = {k: [np.zeros_like(getattr(self, k))] * 2 for k in names}
        for step in range(1, rounds + 1):
            grad = {k: np.zeros_like(getattr(self, k)) for k in names}
            for group in groups:
                for name, slope in zip(names, self._slope(group)):
                    grad[name] += slope
            for name, slope in grad.items():
                slope = slope / len(chains) + ridge * getattr(self, name)
                m, v = moments[name]
                moments[name] = m, v = [0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2]
                move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
                setattr(self, name, getattr(self, name) - move)
        return self

    def _slope(self, chains: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Slope of the negative log likelihood of some chains, in the order of the weights."""
        n, most = len(chains), max(len(t) for _, t in chains)
        size = np.array([len(t) for _, t in chains])
        chain = np.repeat(np.arange(n), size)
        place = np.concatenate([np.arange(s) for s in size])
        features, tags = np.concatenate([f for f, _ in chains]), np.concatenate([t for _, t in chains])
        follow = np.flatnonzero(place > 0)
        pairs = np.zeros((3, 3))
        np.add.at(pairs, (tags[follow - 1], tags[follow]), 1)
        ends = np.cumsum(size) - 1
        e = np.zeros((n, most, 3))
        e[chain, place] = self.scores(features)
        turn = np.exp(self.turn)
        ahead, behind, scale = np.zeros_like(e), np.zeros_like(e), np.ones((n, most))
        e = np.exp(e - e.max(axis=2, keepdims=True))
        ahead[:, 0] = np.exp(self.first) * e[:, 0]
        for t in range(most):
            if t:
                ahead[:, t] = (ahead[:, t - 1] @ turn) * e[:, t]
            scale[:, t] = ahead[:, t].sum(axis=1)
            ahead[:, t] /= scale[:, t, None]
        for t in range(most - 1, -1, -1):
            after = (behind[:, t + 1] * e[:, t + 1]) @ turn.T / scale[:, t + 1, None] if t + 1 < most else 0
            behind[:, t] = np.where((size - 1 == t)[:, None], np.exp(self.last), after)
        held = (ahead * behind)[chain, place]
        miss = held / np.maximum(held.sum(axis=1, keepdims=True), 1e-300)
        miss[np.arange(len(tags)), tags] -= 1
        left, right = ahead[chain[follow], place[follow] - 1], (behind * e)[chain[follow], place[follow]]
        joint = left[:, :, None] * turn * right[:, None, :]
        joint /= np.maximum(joint.sum(axis=(1, 2), keepdims=True), 1e-300)
        emit = np.column_stack([
            sum(np.bincount(features[:, k], miss[:, y], len(self.emit)) for k in range(features.shape[1])) for y in range(3)
        ])
        return emit, joint.sum(axis=0) - pairs, miss[place == 0].sum(axis=0), miss[ends].sum(axis=0)

    def tags(self, tokens: Tokens) -> np.ndarray:
        """Viterbi tags of all texts, each one chain."""
        scores, text = self.scores(tokens.features), tokens.text
        ways_in, ways_out = np.vstack((self.turn, self.first)), np.column_stack((self.turn, self.last))
        gain = max(
            (ways_in[:, y][:, None] - ways_in[:, OUT][:, None] + ways_out[y][None, :] - ways_out[OUT][None, :]).max()
            for y in (BEGIN, INSIDE)
        )
        sure = scores[:, OUT] - scores[:, 1:].max(axis=1) > gain
        tags = np.zeros(len(text), dtype=np.int8)
        open_ = np.flatnonzero(~sure)
        if not len(open_):
            return tags
        cut = np.flatnonzero((np.diff(open_) > 1) | (text[open_[1:]] != text[open_[:-1]])) + 1
        for run in np.split(open_, cut):
            low, high = run[0], run[-1] + 1
            inner = low > 0 and text[low - 1] == text[low]
            best = scores[low] + (self.turn[OUT] if inner else self.first)
            back = []
            for t in range(low + 1, high):
                ways = best[:, None] + self.turn
                back.append(ways.argmax(axis=0))
                best = ways.max(axis=0) + scores[t]
            inner = high < len(text) and text[high] == text[low]
            tag = int((best + (self.turn[:, OUT] if inner else self.last)).argmax())
            tags[high - 1] = tag
            for t in range(high - 2, low - 1, -1):
                tag = int(back[t - low][tag])
                tags[t] = tag
        return tags


def _gold(tokens: Tokens, texts: list[str], spans: list[list[tuple[int, int, int, int]]]) -> np.ndarray:
    """Tags of tokens that lie in the values of base spans."""
    tags = np.zeros(len(tokens.text), dtype=np.int64)
    for i, found in enumerate(spans):
        for _, _, end, value in found:
            low = tokens.first[i] + len(texts[i][:value].encode())
            high = low + len(texts[i][value:end].encode())
            inside = np.flatnonzero((tokens.start < high) & (tokens.end > low))
            tags[inside] = INSIDE
            tags[inside[:1]] = BEGIN
    return tags


ALPHABETS = (
    "0123456789abcdef", "0123456789ABCDEF", string.ascii_letters + string.digits, string.ascii_uppercase + string.digits,
    string.ascii_letters + string.digits + "_-",
)


def _varied(text: str, spans: list[tuple[int, int, int, int]]) -> tuple[str, list[tuple[int, int, int, int]]]:
    """The text with other values in the places of its spans and other words before them; its new spans."""
    rng = random.Random(hashlib.md5(text.encode()).digest())
    made, found, at, size = [], [], 0, 0
    for start, kind, end, value in spans:
        if start < at:
            continue
        cue = text[start:value]
        if kind == 0:
            word = "".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randint(3, 10)))
            cue = word + cue[re.match("[A-Za-z_]+", cue).end() :]
        alphabet = rng.choice(ALPHABETS)
        secret = "".join(rng.choice(alphabet) for _ in range(rng.randint(12, 48)))
        made += [text[at:start], cue, secret]
        size += start - at + len(cue)
        found.append((size, kind, size + len(secret), size))
        size, at = size + len(secret), end
    return "".join(made) + text[at:], found


def learn(documents: DataFrame, sample: int = 4000, context: int = 300, copies: int = 8) -> Field:
    """A field from ``sample`` documents drawn by a hash of their texts.

    Each gives up to four stretches around its base spans, or one stretch at a place that the
    hash names, of ``context`` characters to each side.  A stretch with spans comes in ``copies`` more
    versions with other values and announcing words.  Of the documents only ids and hashes are ranked; the
    chosen texts are fetched by their hash.
    """

    def stretches(batches):
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text)
                middles = [s[0] for s in spans[:4]] or [int(hashlib.md5(text.encode()).hexdigest()[:8], 16) % max(1, len(text))]
                out += [text[max(0, m - context) : m + context] for m in middles]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["text"])

    whole = documents.where("text is not null").select("text", F.xxhash64("text").alias("mark"))
    # At most ``sample`` marks; the rows of one mark are copies, of which one is taken.
    marks = whole.groupBy("mark").count().orderBy("mark").limit(sample).select("mark")
    drawn = whole.join(F.broadcast(marks), "mark").dropDuplicates(["mark"]).select("text")
    texts = sorted(drawn.mapInArrow(stretches, "text string").toArrow()["text"].to_pylist())
    held = [(t, base_spans(t)) for t in texts]
    for text, spans in [x for x in held if x[1]]:
        for k in range(copies):
            changed, found = _varied(text[k:], base_spans(text[k:]))
            held.append((changed, found))
    held.sort()
    bodies = [t.encode() for t, _ in held]
    chains = []
    for low, high in slices(bodies):
        tokens = Tokens(bodies[low:high])
        tags = _gold(tokens, [t for t, _ in held[low:high]], [s for _, s in held[low:high]])
        cut = np.searchsorted(tokens.text, np.arange(high - low + 1))
        chains += [(tokens.features[a:b], tags[a:b]) for a, b in zip(cut[:-1], cut[1:])]
    return Field().train(chains)


def _spans(texts: list[str], field: Field):
    """Sorted (start, kind, end, start of the value) of each text: the patterns' and, outside of them, the field's."""
    bodies = [t.encode() for t in texts]
    for low, high in slices(bodies):
        tokens = Tokens(bodies[low:high])
        tags = field.tags(tokens)
        hits: dict[int, list[list[int]]] = {}
        for t in np.flatnonzero(tags):
            own = hits.setdefault(int(tokens.text[t]), [])
            at = tokens.first[tokens.text[t]]
            if tags[t] == INSIDE and own and t == own[-1][2] + 1:
                own[-1][1:] = [int(tokens.end[t] - at), int(t)]
            else:
                own.append([int(tokens.start[t] - at), int(tokens.end[t] - at), int(t)])
        for i in range(low, high):
            spans = base_spans(texts[i])
            base = list(spans)
            for a, b, _ in hits.get(i - low, ()):
                start = len(bodies[i][:a].decode(errors="ignore"))
                end = start + len(bodies[i][a:b].decode(errors="ignore"))
                if all(end <= s or e <= start for s, _, e, _ in base):
                    spans.append((start, 3, end, start))
            yield sorted(spans)


def find_secrets(documents: DataFrame, field: Field) -> DataFrame:
    """All rows with secrets: an array of (kind, start, end, value_start) in code points, sorted.

    Kinds are the patterns' and ``tagged`` for what the field adds outside every base span.  Null
    and empty texts have none.  An input column named secrets is replaced.
    """
    rest = [c for c in documents.columns if c != "secrets"]
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value_start", pa.int64())]))

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            out = [
                [{"kind": KINDS[k], "start": s, "end": e, "value_start": v} for s, k, e, v in spans]
                for spans in _spans(texts, field)
            ]
            yield batch.append_column("secrets", pa.array(out, kind))

    shape = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in rest)
    return documents.select(*rest).mapInArrow(
        run, f"{shape}, secrets array<struct<kind: string, start: long, end: long, value_start: long>>"
    )


def report(found: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans and n_tagged of ``find_secrets``'s rows."""
    joined = "concat_ws(',', transform({}, s -> concat_ws(':', s.kind, s.start, s.end)))"
    base = "filter(secrets, s -> s.kind <> 'tagged')"
    count = "cast(size(filter(secrets, s -> s.kind = '{}')) as long)"
    return found.select(
        "doc_id", *(F.expr(count.format(k)).alias(f"n_{k}") for k in KINDS),
        F.sha2(F.expr(joined.format(base)), 256).alias("base_sha256"), F.expr(joined.format("secrets")).alias("spans"),
    )


def redact(documents: DataFrame, field: Field) -> DataFrame:
    """The documents with every secret value written as <secret>; null texts stay null.

    Values are found and written over in one pass.
    """

    def run(batches):
        for batch in batches:
            held = batch.column("text").to_pylist()
            texts = []
            for text, spans in zip(held, _spans([t or "" for t in held], field)):
                made, at = [], 0
                for _, _, end, value in sorted(spans, key=lambda x: x[3]):
                    if value >= at:
                        made += [text[at:value], "<secret>"]
                    at = max(at, end)
                texts.append(text if not made else "".join(made) + text[at:])
            yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))

    shape = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in documents.columns)
    return documents.mapInArrow(run, shape)
