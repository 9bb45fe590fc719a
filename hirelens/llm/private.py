"""Personal data: spans found by fixed patterns, and spans added by weak supervision.

Wide patterns propose candidates of each kind. Labelers look at a candidate and vote that it is
personal data, that it isn't, or not at all: the shape (a regex), its check digits, a gazetteer
of prefixes and endings, the words before it, the characters around it, and its own digits.
How often each combination of votes occurs is counted over all documents; expectation
maximisation on those counts estimates how reliable each labeler is and how probable each
combination makes personal data. A logistic classifier per kind is trained on these
probabilities over vote and shape features, and decides which candidates become spans.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, rows_of, text_slices

KINDS = ("email", "ip", "card", "phone")
ABSTAIN, NO, YES = 0, 1, 2
LABELERS = ("shape", "check", "gazetteer", "context", "border", "digits")
FEATURES = 4  # shape bits beside the votes
THRESHOLD = 0.5
BEFORE = 40  # code points before a candidate that hold its context
ROUNDS = 200
CHECK_REJECTS = 1e-3

# ---- base spans: fixed patterns ----------------------------------------------

# Possessive repeats and the look-behind only keep the search linear; they match the same.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @: no part of an address holds another one."""
    done, at = 0, text.find("@")
    while at >= 0:
        start, after = at, at + 1
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, after) if start < at else None
        if found:
            yield start, found.end()
            after = done = found.end()
        else:
            done = max(done, after)
        at = text.find("@", after)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches, sorted; failing ones are dropped."""
    spans = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    spans += [
        (m.start(), 1, m.end())
        for m in _IP.finditer(text)
        if all(int(p[-4:]) <= 255 and not p[:-4].strip("0") for p in m.group().split("."))
    ]
    for m in _CARD.finditer(text):
        digits = digits_of(m.group()) if m.end() - m.start() >= 14 else ""
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), 2, m.end()))
    if "+" in text:
        spans += [
            (m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(digits_of(m.group())) <= 15
        ]
    return sorted(spans)


# ---- candidates and labelers -------------------------------------------------

# Wide patterns; repeats are bounded so that a match is short however long the text is.
_WIDE = (
    re.compile(r"(?<![^\s<>()\[\]\",;:])[^\s<>()\[\]\",;:@]{1,64}(?:@| ?[\[(]at[\])] ?)[\w-]{1,63}(?:(?:\.| ?[\[(]dot[\])] ?)[\w-]{1,63}){1,6}"),
    re.compile(r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w])|(?<![\w:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![\w:])"),
    re.compile(r"(?<![0-9])[0-9]{4}(?:[ ./-]?[0-9]{4}){2}[ ./-]?[0-9]{1,7}(?![0-9])|(?<![0-9])3[47][0-9]{2}[ ./-]?[0-9]{6}[ ./-]?[0-9]{5}(?![0-9])"),
    re.compile(r"(?<![0-9A-Za-z.])(?:00[1-9]|\(?0?[0-9]{2,4}\)?)[ ./-]{0,2}[0-9]{2,4}(?:[ ./-]{1,2}[0-9]{2,5}){1,4}(?![0-9])"),
)
_AT = re.compile(r"@|[\[(]at[\])]")
_STRICT = (
    re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,24}"),
    re.compile(r"(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}|[0-9A-Fa-f:]{39}"),
    re.compile(r"[0-9]{13,16}|[0-9]{4}([ .-])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}"),
    re.compile(r"00[1-9][0-9 ./-]+|\(?[0-9]{3}\)?[ -][0-9]{3}[ -][0-9]{4}|0[0-9]{2,4}[ /-][0-9 -]{5,9}"),
)
_LOOSE = (
    re.compile(r"\.{2}|@[^@]*[^\x00-\x7F]|[._%+-]@"),
    re.compile(r"(?:^|\.)0[0-9]"),
    re.compile(r"[./]"),
    re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{2,4}"),
)
# Gazetteers, fixed values: endings of public domains; first digits of card issuers; words of context.
_ENDINGS = frozenset("com org net edu gov info io de fr es uk it nl ch at eu us ca au br in jp cn ru mx pl se no".split())
_ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6011|65|35|30[0-5]|36")
_RESERVED = re.compile(r"0\.|127\.|255\.|169\.254\.|22[4-9]\.|2[34][0-9]\.")
_DIALING = re.compile(r"00[1-9]|\(?0[1-9]|\(?[2-9][0-9]{2}\)?[ -]")
_NEAR = (
    re.compile(r"\b(?:e-?mail|mail|contact|write|reach|adresse|correo|courriel)\b", re.I),
    re.compile(r"\b(?:ip|host|server|client|address|addr|from|login)\b", re.I),
    re.compile(r"\b(?:card|visa|mastercard|amex|credit|debit|payment|karte|carte|tarjeta)\b", re.I),
    re.compile(r"\b(?:tel|phone|call|mobile|cell|fax|whatsapp|sms|telefon|téléphone|teléfono)\b", re.I),
)
_FAR = (
    re.compile(r"\b(?:example|user|noreply|no-reply|git)\b", re.I),
    re.compile(r"\b(?:version|release|section|chapter|oid|build|v)\b", re.I),
    re.compile(r"\b(?:isbn|issn|order|serial|tracking|invoice|id|no|number|hash|token)\b", re.I),
    re.compile(r"\b(?:date|isbn|issn|version|order|id|page|pages|pp|score|between)\b", re.I),
)


def votes_of(kind: int, text: str, start: int, end: int) -> tuple[int, int]:
    """The labelers' votes as digits of base 3, and the shape bits, of one candidate."""
    found, digits = text[start:end], digits_of(text[start:end])
    before = text[max(0, start - BEFORE) : start]
    left, right = text[start - 1 : start], text[end : end + 1]
    shape = YES if _STRICT[kind].fullmatch(found) else NO if _LOOSE[kind].search(found) else ABSTAIN
    if kind == 0:
        check = ABSTAIN
        gazetteer = YES if found.rsplit(".", 1)[-1].lower() in _ENDINGS else NO
    elif kind == 1:
        parts = found.split(".")
        check = ABSTAIN if len(parts) < 4 else YES if all(int(p) <= 255 for p in parts) else NO
        gazetteer = NO if _RESERVED.match(found) else ABSTAIN
    elif kind == 2:
        check = YES if luhn(digits) else NO
        gazetteer = YES if _ISSUERS.match(digits) else NO
    else:
        check = YES if 10 <= len(digits) <= 12 else NO if len(digits) < 8 or len(digits) > 15 else ABSTAIN
        gazetteer = YES if _DIALING.match(found) else NO
    context = YES if _NEAR[kind].search(before) else NO if _FAR[kind].search(before) else ABSTAIN
    if left.isalnum() or right.isalnum() or left in ("/", "=", "#", "_", "."):
        border = NO
    else:
        border = YES if right in (",", ";", ")", "\n", "") or left in (":", "(", "<", "\n", "") else ABSTAIN
    spread = len(set(digits)) if kind else len(set(found.split("@")[0]))
    varied = NO if spread <= 2 else YES if spread >= 5 else ABSTAIN
    code = 0
    for vote in (shape, check, gazetteer, context, border, varied):
        code = code * 3 + vote
    bits = (len(found) > len(digits)) | (len(digits) >= 12) << 1 | (" " in found) << 2 | (found[0] in "(0+") << 3
    return code, bits


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """(start, kind, end, votes, bits) of what the wide patterns find, and of base spans of those kinds.

    A base span stands for itself; other candidates that overlap any base span are left out.
    """
    starts = [a for a, _, _ in base]
    reach = list(accumulate((b for _, _, b in base), max))  # no span up to here ends later
    out = [(a, k, b, *votes_of(k, text, a, b)) for a, k, b in base]
    for kind, pattern in enumerate(_WIDE):
        if kind == 0 and not _AT.search(text):
            continue
        for m in pattern.finditer(text):
            a, b = m.span()
            earlier = bisect_left(starts, b)
            if not earlier or reach[earlier - 1] <= a:
                out.append((a, kind, b, *votes_of(kind, text, a, b)))
    return sorted(out)


# ---- the label model ---------------------------------------------------------


def votes_in(codes: np.ndarray) -> np.ndarray:
    """Votes of each code, a column per labeler."""
    places = 3 ** np.arange(len(LABELERS) - 1, -1, -1)
    return codes[:, None] // places % 3


@dataclass(frozen=True)
class Reliability:
    """Share of personal data among a kind's candidates; per class (no, yes) and labeler the chance of each vote."""

    share: float
    chances: np.ndarray

    def posterior(self, codes: np.ndarray) -> np.ndarray:
        """How probable personal data is, given each code's votes."""
        votes = votes_in(codes)
        logs = np.log(self.chances)
        like = sum(logs[:, j, votes[:, j]] for j in range(len(LABELERS)))
        odds = like[1] - like[0] + np.log(self.share) - np.log1p(-self.share)
        return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))


def fit_reliability(codes: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> Reliability:
    """Expectation maximisation over counted vote combinations, independent given the class.

    It starts from the majority of the votes, which also says which class is which; a fixed
    prior of few candidates that vote with their class keeps the classes from swapping. Check
    digits and lengths are part of what such a number is, so the chance that ``check`` rejects a
    true one is not estimated but known: ``CHECK_REJECTS``.
    """
    check = LABELERS.index("check")
    votes = votes_in(codes)
    balance = (votes == YES).sum(1) - (votes == NO).sum(1)
    weight = 1 / (1 + np.exp(-1.5 * balance))
    prior = np.array([[0.5, 2.0, 0.5], [0.5, 0.5, 2.0]])
    model = None
    for _ in range(rounds):
        chances = np.empty((2, len(LABELERS), 3))
        for c, w in enumerate((1 - weight, weight)):
            for j in range(len(LABELERS)):
                seen = np.bincount(votes[:, j], weights=w * counts, minlength=3) + prior[c]
                chances[c, j] = seen / seen.sum()
        others = chances[1, check, [ABSTAIN, YES]]
        chances[1, check, NO] = CHECK_REJECTS
        chances[1, check, [ABSTAIN, YES]] = others / others.sum() * (1 - CHECK_REJECTS)
        share = float(np.clip((weight @ counts + 1) / (counts.sum() + 2), 1e-6, 1 - 1e-6))
        model = Reliability(share, chances)
        new = model.posterior(codes)
        if np.abs(new - weight).max(initial=0) < 1e-9:
            break
        weight = new
    return model


def inputs_of(codes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """One row per candidate: a constant, one column per labeler's yes and no, the shape bits."""
    votes = votes_in(codes)
    flags = (bits[:, None] >> np.arange(FEATURES)) & 1
    return np.concatenate([np.ones((len(codes), 1)), votes == YES, votes == NO, flags], axis=1).astype(np.float64)


def fit_logistic(x: np.ndarray, y: np.ndarray, counts: np.ndarray, penalty: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights by Newton steps on the weighted cross entropy with probabilities ``y`` as targets."""
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[0] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        slope = x.T @ (counts * (p - y)) + ridge * w
        curve = (x * (counts * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 4.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return w


@dataclass(frozen=True)
class SpanModel:
    """Per kind the labelers' reliability and the classifier's weights; kinds without candidates have none."""

    reliability: dict[int, Reliability]
    weights: dict[int, np.ndarray]

    def probability(self, kind: int, codes: np.ndarray, bits: np.ndarray) -> np.ndarray:
        if kind not in self.weights:
            return np.zeros(len(codes))
        return 1 / (1 + np.exp(-np.clip(inputs_of(codes, bits) @ self.weights[kind], -40, 40)))


def fit_spans(counted: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]) -> SpanModel:
    """Reliabilities and classifiers from (codes, bits, counts) of each kind.

    Counts of the kind are scaled to at most 10,000 in total for the classifier, so its penalty
    weighs the same at every size.
    """
    reliability, weights = {}, {}
    for kind, (codes, bits, counts) in counted.items():
        distinct, at = np.unique(codes, return_inverse=True)
        reliability[kind] = fit_reliability(distinct, np.bincount(at, weights=counts))
        target = reliability[kind].posterior(codes)
        weights[kind] = fit_logistic(inputs_of(codes, bits), target, counts * min(1.0, 1e4 / counts.sum()))
    return SpanModel(reliability, weights)


def choose(found: list[tuple[int, int, int, float]], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The base spans and those candidates (start, kind, end, probability) that pass, sorted.

    Candidates that overlap each other give way to the more probable, then the earlier, then
    the kind listed first.
    """
    out, starts, ends = list(base), [], []  # of the chosen, which don't overlap
    for a, k, b, p in sorted(found, key=lambda c: (-c[3], c[0], c[1])):
        if p < THRESHOLD:
            break
        at = bisect_right(starts, a)
        if (at == 0 or ends[at - 1] <= a) and (at == len(starts) or starts[at] >= b):
            starts.insert(at, a)
            ends.insert(at, b)
            out.append((a, k, b))
    return sorted(out)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


# ---- Spark -------------------------------------------------------------------

_FOUND = "base string, n_email long, n_ip long, n_card long, n_phone long, found array<struct<start: int, kind: int, stop: int, votes: int, bits: int, given: boolean>>"
_SPAN = pa.struct([(c, pa.int32()) for c in ("start", "kind", "stop", "votes", "bits")] + [("given", pa.bool_())])


def find_candidates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, counts by kind, found): base spans as text, and every candidate with its votes."""
    columns = [("base", pa.string()), *[(f"n_{k}", pa.int64()) for k in KINDS], ("found", pa.list_(_SPAN))]
    schema = pa.schema(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, most=1 << 20):
            rows = []
            for text in texts.strings():
                base = base_spans(text)
                given = set(base)
                found = [
                    {"start": a, "kind": k, "stop": b, "votes": v, "bits": s, "given": (a, k, b) in given}
                    for a, k, b, v, s in candidates(text, base)
                ]
                kinds = [k for _, k, _ in base]
                rows.append((written(base), *(kinds.count(k) for k in range(len(KINDS))), found))
            out = rows_of(schema, *zip(*rows))
            yield pa.RecordBatch.from_arrays([batch.column(0), *out.columns], names=["id", *schema.names])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, {_FOUND}")


def fit_span_model(found: DataFrame) -> SpanModel:
    """The model from all candidates of a frame with ``found``.

    The driver receives counts by kind, votes and shape bits: at most 4 x 3**6 x 2**4 rows,
    whatever the number of documents.
    """
    each = found.select(F.explode("found").alias("c")).groupBy("c.kind", "c.votes", "c.bits").agg(F.count(F.lit(1)).alias("n"))
    counted: dict[int, list] = {}
    for r in sorted(each.collect()):
        counted.setdefault(r["kind"], []).append((r["votes"], r["bits"], r["n"]))
    return fit_spans({k: tuple(np.array(c) for c in zip(*rows)) for k, rows in counted.items()})


def add_spans(found: DataFrame, model: SpanModel) -> DataFrame:
    """``found`` with ``spans``: base spans and the candidates that the model takes for personal data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(batch.schema.get_field_index("found")).to_pylist()
            new = [(i, c) for i, found in enumerate(rows) for c in found if not c["given"]]
            scored: list[list] = [[] for _ in rows]
            for kind in range(len(KINDS)):
                of_kind = [(i, c) for i, c in new if c["kind"] == kind]
                votes, bits = (np.array([c[x] for _, c in of_kind], np.int64) for x in ("votes", "bits"))
                for (i, c), p in zip(of_kind, model.probability(kind, votes, bits).tolist()):
                    scored[i].append((c["start"], kind, c["stop"], p))
            given = [[(c["start"], c["kind"], c["stop"]) for c in found if c["given"]] for found in rows]
            spans = [written(choose(s, g)) for s, g in zip(scored, given)]
            yield batch.append_column("spans", pa.array(spans, pa.string()))

    return found.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema) + ", spans string")


def find_private(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base, spans, found) for each row of ``df``.

    ``base`` and ``spans`` list `kind:start:end` by start and kind, in code points with an
    exclusive end; the counts are of the base spans, which are all in ``spans`` too. ``found``
    has every candidate with its votes. Base spans are the matches of the fixed patterns, per kind
    leftmost and without overlap; spans that the model adds overlap no other span.

    A null or empty text has no spans, texts are searched whole. Rows are answered one by one:
    repeated rows and null ids come back as they are, and repeated rows count as often in the
    model. An empty table gives no rows, one without candidates a model that adds nothing. Other
    columns of ``df`` are not read. Texts are read once; the model sees the stored candidates.
    """
    stored = cut(find_candidates(df, id_col, text_col))
    counts = [f"n_{k}" for k in KINDS]
    return add_spans(stored, fit_span_model(stored)).select(F.col("id").alias(id_col), *counts, "base", "spans", "found")
