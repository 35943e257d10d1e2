"""Personal data by weak supervision.

Base patterns give spans that always stay.  Wider patterns propose further
candidates, hard negatives (card numbers of a wrong checksum, addresses with a
part above 255) among them; four labelers (form, gazetteer, context before,
make-up of the string) vote for, against or abstain on each.  The gazetteer is
gathered from the base spans of the corpus (mail domains, card and phone
prefixes, networks) beside short fixed lists.  Expectation-maximisation on the
counts of vote patterns estimates each labeler's reliability and a posterior
per pattern.  The posteriors are the soft labels of the final span classifier,
a logistic regression over votes, the string's shape and the words around it,
fitted on at most ``sample_spans`` spans.  Candidates that it accepts are added.

One pass over the texts writes what was found (no text); all later steps read
that table, and no text is shuffled.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.llm._common import as_table, map_text, text_of

SLICE_BYTES = 4 << 20
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "ssn")
LABELERS = ("form", "gazetteer", "context", "makeup")

# Base patterns (fixed values of the contract, some written so that they run in linear time).
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_NEAR_WORD = re.compile(r"[^\W\d_]+")
#: Number of hashed features.
HASHED = 4096

# Wider patterns that propose candidates.
_WIDER = (
    ("phone", re.compile(r"(?<![0-9A-Za-z.+-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])")),
    ("ssn", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")),
    ("secret", re.compile(r"(?<![A-Za-z0-9_])(?:AKIA|ASIA|ghp_|sk-|xoxb-)[A-Za-z0-9_-]{12,}")),
    ("secret", re.compile(r"(?<![A-Za-z0-9_])(?:password|passwd|pwd|token|secret|api[_-]?key|access[_-]?key) ?[=:] ?[\"']?([^\s\"']{8,})", re.I)),
)
_SPELT_AT = re.compile(r" ?(?:\[at\]|\(at\)) ?[A-Za-z0-9-]+(?: ?(?:\[dot\]|\(dot\)|\.) ?[A-Za-z]{2,})+", re.I)
# Gazetteers and cues (fixed values).
_ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65")
_ENDINGS = frozenset("com net org edu gov io de fr es uk eu info example".split())
_KEY_HEADS = ("AKIA", "ASIA", "ghp_", "sk-", "xoxb-")
_CUES = {
    "email": re.compile(r"(?:e-?mail|contact|write|mailto|reach|correo)\W*(?:\w+\W+){0,3}\Z", re.I),
    "ip": re.compile(r"(?:ip|address|host|server|from)\W*(?:\w+\W+){0,2}\Z", re.I),
    "card": re.compile(r"(?:card|visa|mastercard|credit|karte|carte|tarjeta)\W*(?:\w+\W+){0,3}\Z", re.I),
    "phone": re.compile(r"(?:phone|tel|call|mobile|cell|fax|t[ée]l[ée]phone|telefon)\W*(?:\w+\W+){0,3}\Z", re.I),
    "secret": re.compile(r"(?:password|passwd|pwd|token|secret|key)\W*(?:\w+\W+){0,1}\Z", re.I),
    "ssn": re.compile(r"(?:ssn|social security|security number)\W*(?:\w+\W+){0,2}\Z", re.I),
}
_AGAINST = re.compile(r"(?:version|isbn|issn|page|chapter|order|item|article|serial|part)\W*(?:no|number|nr)?\W*\Z", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _local_start(text: str, at: int, end: int) -> int:
    """Where the run of local-part characters before ``at`` begins, not before ``end``."""
    start = at
    while piece := _LOCAL_END.search(text, max(end, start - 256), start):
        step, start = start - piece.start(), piece.start()
        if step < 256:
            break
    return start


def _matches(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(kind's number, start, end) of the base patterns, by kind and start; and the matches of cards and addresses that fail."""
    spans, failed, end = [], [], 0
    at = text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at)
        if domain and (start := _local_start(text, at, end)) < at:
            spans.append((0, start, domain.end()))
            end = domain.end()
        at = text.find("@", max(at + 1, end))
    if not _DIGITS.search(text):
        return spans, failed
    for m in _IP.finditer(text):
        good = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))
        (spans if good else failed).append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19:
            (spans if luhn(digits) else failed).append((2, m.start(), m.end()))
    if "+" in text:
        spans += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_DIGITS.findall(m[0])) <= 15]
    return spans, failed


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind's number, start, end) of the base patterns, by kind and start."""
    return _matches(text)[0]


def _votes(kind: int, text: str, start: int, end: int, form: int) -> tuple[int, ...]:
    """One vote per labeler: 1 for, -1 against, 0 abstains; the gazetteer's is that of the fixed lists."""
    value, name, before = text[start:end], KINDS[kind], text[max(0, start - 48) : start]
    digits = _DIGITS.findall(value)
    if name == "ssn" and value[:3] not in ("000", "666") and value[0] != "9" and value[4:6] != "00":
        form = 1
    if name == "secret":
        form = 1 if value.startswith(_KEY_HEADS) or len(value) >= 12 else -1
        gazetteer = 1 if value.startswith(_KEY_HEADS) or _CUES["secret"].search(before) else 0
    elif name == "card":
        gazetteer = 1 if "".join(digits).startswith(_ISSUERS) else -1
    elif name == "email":
        gazetteer = 1 if re.split(r"[^a-z]+", value.lower().rstrip(")] "))[-1] in _ENDINGS else 0
    elif name == "ip":
        gazetteer = -1 if value.split(".")[0].lstrip("0") in ("", "127", "255") else 1
    else:
        gazetteer = 0
    context = -1 if _AGAINST.search(before) else 1 if _CUES[name].search(before) else 0
    share = len(digits) / len(value)
    kinds = len({c.isdigit() + 2 * c.islower() + 4 * c.isupper() for c in value})
    makeup = (1 if kinds > 1 and 0.1 <= share <= 0.9 and len(set(value)) >= 6 else -1) if name == "secret" else (1 if len(set(digits)) > 2 else -1) if digits else 0
    return form, gazetteer, context, makeup


def _gazetteer_key(kind: int, value: str) -> str:
    """What the corpus's gazetteer keeps of a value: its domain, network or prefix; '' if nothing."""
    if KINDS[kind] == "email":
        return ".".join(re.split(r"[^a-z0-9-]+", re.sub(r"\W*\b(?:at|dot)\b\W*", ".", value.lower()).strip("."))[-2:])
    if KINDS[kind] == "ip":
        return ".".join(value.split(".")[:2])
    digits = "".join(_DIGITS.findall(value))
    return digits[:4] if KINDS[kind] == "card" else digits[-10:-7] if KINDS[kind] == "phone" else ""


def _features(kind: int, text: str, start: int, end: int) -> list[int]:
    """Numbers of the classifier's features: the string's shape and length, and the words around it."""
    shape = re.sub(r"(.)\1+", r"\1+", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "0", text[start : min(end, start + 64)]))))
    before, after = _NEAR_WORD.findall(text[max(0, start - 48) : start].lower())[-3:], _NEAR_WORD.findall(text[end : end + 32].lower())[:2]
    names = [f"shape {shape[:16]}", f"length {min(end - start, 64) // 8}", *[f"before {w}" for w in before], *[f"next {w}" for w in before[-1:]], *[f"after {w}" for w in after]]
    return sorted({zlib.crc32(f"{KINDS[kind]} {x}".encode("utf-8", "surrogatepass")) % HASHED for x in names})


def pattern_code(kind: int, votes: tuple[int, ...]) -> int:
    code = kind
    for v in votes:
        code = code * 3 + v + 1
    return code


def pattern_of(code: int) -> tuple[int, list[int]]:
    votes = []
    for _ in LABELERS:
        code, v = divmod(code, 3)
        votes.append(v - 1)
    return code, votes[::-1]


def candidates(text: str, base: list[tuple[int, int, int]], failed: list[tuple[int, int, int]] | None = None) -> list[tuple[int, int, int, tuple[int, ...]]]:
    """(kind, start, end, votes) of proposed spans that touch no base span, leftmost and longest first.

    A secret that base spans touch is proposed in the parts that they leave.
    """
    failed = _matches(text)[1] if failed is None else failed
    found = [(s, -e, k, -1) for k, s, e in failed]
    for name, pattern in _WIDER:
        for m in pattern.finditer(text):
            group = 1 if pattern.groups and m[1] else 0
            found.append((m.start(group), -m.end(group), KINDS.index(name), 0))
    if "(at)" in (lowered := text.lower()) or "[at]" in lowered:
        end = 0
        for m in _SPELT_AT.finditer(text):
            if (start := _local_start(text, m.start(), end)) < m.start():
                found.append((start, -m.end(), 0, 0))
                end = m.end()
    if not found:
        return []
    taken, out = sorted((s, e) for _, s, e in base), []
    starts = [s for s, _ in taken]
    last = 0
    for start, end, kind, form in sorted(found):
        end = -end
        touched = [x for x in taken[max(0, bisect_left(starts, start) - len(BASE_KINDS)) : bisect_left(starts, end)] if x[1] > start]
        if start < last or touched and KINDS[kind] != "secret":
            continue
        votes, at = _votes(kind, text, start, end, form), start
        for s, e in [*touched, (end, end)]:
            if s > at:
                out.append((kind, at, s, votes))
            at = max(at, e)
        last = end
    return out


class SpanClassifier:
    """Reliabilities by EM on counts of vote patterns, and a logistic classifier over votes, kinds and hashed features.

    ``spans`` are (code, feature numbers) of the spans that the classifier is fitted on.
    """

    def __init__(self, counts: dict[int, int], spans: list[tuple[int, list[int]]] = (), gazetteer: frozenset[tuple[int, str]] = frozenset(), rounds: int = 50):
        self.gazetteer = gazetteer
        codes = list(counts)
        patterns = [pattern_of(code) for code in codes]
        weight = np.array(list(counts.values()), float)
        votes = np.array([v for _, v in patterns], int).reshape(-1, len(LABELERS))
        kinds = np.array([k for k, _ in patterns], int)
        # Probabilities of a vote (against, none, for) when the span is none, and when it is one.
        table = np.repeat(np.array([[[0.5, 0.4, 0.1]], [[0.05, 0.35, 0.6]]]), len(LABELERS), axis=1)
        prior = np.full(len(KINDS), 0.5)
        post = np.zeros(len(weight))
        for _ in range(rounds if len(weight) else 0):
            log = [np.log(prior[kinds] if y else 1 - prior[kinds]) + sum(np.log(table[y, k, votes[:, k] + 1]) for k in range(len(LABELERS))) for y in (0, 1)]
            post = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
            for kind in range(len(KINDS)):
                here = kinds == kind
                prior[kind] = (weight[here] @ post[here] + 5) / (weight[here].sum() + 10)
            for y, p in ((0, 1 - post), (1, post)):
                for k in range(len(LABELERS)):
                    n = np.array([(weight * p)[votes[:, k] == v].sum() for v in (-1, 0, 1)]) + np.array([[5.0, 4, 1], [0.5, 3.5, 6]])[y]
                    table[y, k] = n / n.sum()
        self.reliability, self.prior = table, prior
        self.posterior = dict(zip(codes, post.tolist(), strict=True))
        self.weights = np.zeros(len(self._dense(0)) + HASHED)
        if len(spans):
            self._fit(spans)

    @staticmethod
    def _dense(code: int) -> list[float]:
        kind, votes = pattern_of(code)
        return [1.0, *[float(k == kind) for k in range(len(KINDS))], *[float(v == x) for v in votes for x in (-1, 1)]]

    def _fit(self, spans: list[tuple[int, list[int]]], rounds: int = 400) -> None:
        """Gradient ascent with steps scaled by each weight's past gradients."""
        dense = np.array([self._dense(code) for code, _ in spans])
        soft = np.array([self.posterior.get(code, 0.5) for code, _ in spans])
        row = np.repeat(np.arange(len(spans)), [len(f) for _, f in spans])
        column = np.array([f for _, fs in spans for f in fs], int)
        d = dense.shape[1]
        past = np.full(len(self.weights), 1e-8)
        for _ in range(rounds):
            margin = dense @ self.weights[:d] + np.bincount(row, self.weights[d + column], len(spans))
            error = soft - 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
            step = np.concatenate([dense.T @ error, np.bincount(column, error[row], HASHED)]) - 0.01 * self.weights
            past += step * step
            self.weights += 0.5 * step / np.sqrt(past)

    def code_of(self, kind: int, votes: tuple[int, ...] | list[int], key: str) -> int:
        """The vote pattern, with the corpus's gazetteer heard."""
        form, gazetteer, context, makeup = votes
        return pattern_code(kind, (form, 1 if (kind, key) in self.gazetteer else gazetteer, context, makeup))

    def probability(self, code: int, features: list[int] = ()) -> float:
        dense = self._dense(code)
        margin = float(np.dot(dense, self.weights[: len(dense)])) + sum(float(self.weights[len(dense) + f]) for f in features)
        return 1 / (1 + math.exp(-min(max(margin, -30.0), 30.0)))


#: What is found in a text; votes are those of the fixed lists, -1 to 1.
FOUND = "array<struct<kind:int,start:int,end:int,base:boolean,votes:array<int>,key:string,features:array<int>>>"


def extract(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id and ``found``, the base spans and candidates with votes and features."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("votes", pa.list_(pa.int32())), ("key", pa.string()), ("features", pa.list_(pa.int32()))]))

        def one(text: str) -> list[dict]:
            base, failed = _matches(text)
            some = [(k, s, e, True, _votes(k, text, s, e, 1)) for k, s, e in base] + [(k, s, e, False, v) for k, s, e, v in candidates(text, base, failed)]
            return [{"kind": k, "start": s, "end": e, "base": b, "votes": v, "key": _gazetteer_key(k, text[s:e]), "features": _features(k, text, s, e)} for k, s, e, b, v in some]

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([part.column(0), pa.array([one(x) for x in part.column(1).to_pylist()], kind)], ["doc_id", "found"])

        yield from map_text(batches, SLICE_BYTES, work)

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id long, found {FOUND}")


def fit_found(found: DataFrame, sample_spans: int = 20_000, gazetteer_keys: int = 10_000, min_docs: int = 3) -> SpanClassifier:
    """Fit on an extracted table.  To the driver come the ``gazetteer_keys`` keys of most base spans (in ``min_docs`` documents or more),
    at most kinds x 3^labelers counts and ``sample_spans`` spans."""
    spans = found.select("doc_id", F.explode("found").alias("f")).select("doc_id", "f.*")
    keys = spans.filter("base AND key <> ''").groupBy("kind", "key").agg(F.count_distinct("doc_id").alias("n")).filter(F.col("n") >= min_docs)
    gazetteer = frozenset((r["kind"], r["key"]) for r in keys.orderBy(F.desc("n"), "kind", "key").limit(gazetteer_keys).collect())
    listener = SpanClassifier({}, (), gazetteer)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [listener.code_of(k, v, key) for k, v, key in zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int32()), batch.column(3), batch.column(4)], ["code", "features", "order"])

    order = F.xxhash64("doc_id", "kind", "start", "end")
    coded = spans.select("kind", "votes", "key", "features", order.alias("order")).mapInArrow(run, "code int, features array<int>, order long")
    counts = {r["code"]: r["n"] for r in coded.groupBy("code").agg(F.count("*").alias("n")).orderBy("code").collect()}
    sample = [(r["code"], r["features"]) for r in coded.orderBy("order", "code").limit(sample_spans).collect()]
    return SpanClassifier(counts, sample, gazetteer)


def fit(df: DataFrame, text_col: str = "text", sample_spans: int = 20_000) -> SpanClassifier:
    """Fit on all texts of ``df``; null texts hold nothing, repeated rows count each, an empty table gives a model that accepts nothing."""
    return fit_found(as_table(extract(df.select(F.xxhash64(text_of(text_col)).alias("doc_id"), F.col(text_col).alias("text")))), sample_spans)


def _accepts(model: SpanClassifier, threshold: float):
    known: dict[tuple, bool] = {}

    def accepts(kind: int, votes, key: str, features) -> bool:
        at = (kind, *votes, key, *features)
        if at not in known:
            if len(known) > 100_000:
                known.clear()
            known[at] = model.probability(model.code_of(kind, votes, key), features) >= threshold
        return known[at]

    return accepts


def spans_of(text: str, accepted: frozenset[int]) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and all spans with the candidates of the accepted vote patterns, each by kind and start."""
    base, failed = _matches(text)
    more = [(k, s, e) for k, s, e, votes in candidates(text, base, failed) if pattern_code(k, votes) in accepted]
    return base, sorted([*base, *more])


SPAN = "array<struct<kind:string,start:int,end:int>>"


def find_spans(df: DataFrame, model: SpanClassifier | None = None, threshold: float = 0.9, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, ``base`` and ``spans``: arrays of (kind, start, end), in code points, by kind as listed, then start.

    Without a model, one is fitted on what is found here, so the texts are read
    once.  Null and empty texts have no spans; repeated rows are treated alike;
    an empty table gives no rows; other columns are ignored.
    """
    found = extract(df, id_col, text_col)
    if model is None:
        found = as_table(found)
        model = fit_found(found)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        accepts = _accepts(model, threshold)
        named = lambda spans: [{"kind": KINDS[k], "start": s, "end": e} for k, s, e in sorted(spans)]
        for batch in batches:
            base, more = [], []
            for spans in batch.column(1).to_pylist():
                base.append(named((x["kind"], x["start"], x["end"]) for x in spans if x["base"]))
                more.append(named((x["kind"], x["start"], x["end"]) for x in spans if x["base"] or accepts(x["kind"], x["votes"], x["key"], x["features"])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, kind), pa.array(more, kind)], ["doc_id", "base", "spans"])

    return found.mapInArrow(run, f"doc_id long, base {SPAN}, spans {SPAN}")


def redact(df: DataFrame, model: SpanClassifier, threshold: float = 0.9, text_col: str = "text") -> DataFrame:
    """``df`` with every span in ``text_col`` replaced by its kind in brackets.

    A null text stays null, an empty one empty; repeated rows are redacted
    alike; an empty table gives no rows; all other columns stay.
    """

    @F.pandas_udf("string")
    def clean(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        accepts = _accepts(model, threshold)

        def one(text: str | None) -> str | None:
            if not text:
                return text
            base, failed = _matches(text)
            more = [(k, s, e) for k, s, e, v in candidates(text, base, failed) if accepts(k, v, _gazetteer_key(k, text[s:e]), _features(k, text, s, e))]
            out, last = [], 0
            for start, end, kind in sorted((s, e, k) for k, s, e in [*base, *more]):
                if end > last:
                    out += [text[last : max(start, last)], f"[{KINDS[kind].upper()}]"]
                    last = end
            return "".join(out) + text[last:]

        for texts in parts:
            yield texts.map(one, na_action="ignore")

    return df.withColumn(text_col, clean(F.col(text_col)))
