"""Personal data (operator 3): base patterns, and candidates judged by boosted trees."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.registry import query, table
from newsloom.llm.sampling import hashed_sample
from newsloom.llm.trees import BoostedTrees, threshold_for

KINDS = ("email", "ip", "card", "phone")
#: The trees are fitted on at most so many documents.
SAMPLE_DOCS = 2_000
#: Thresholds are set where held-out candidates reach this precision.
PRECISION = 0.98

# The base patterns. A start within a run of characters, where the start of the run has failed, would
# fail too, so looking behind and possessive repeats change no match but keep long runs linear.
_MAIL_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_MAIL_HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[str, int, int]


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns, kind by kind, each from left to right."""
    found: list[Span] = []
    behind, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > behind and text[start - 1] in _MAIL_NAME:
            start -= 1
        host = _MAIL_HOST.match(text, at) if start < at else None
        if host:
            found.append(("email", start, host.end()))
            behind = host.end()
        else:
            behind = max(behind, at)
        at = text.find("@", at + 1 if not host else behind)
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or "0") <= 255 for x in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        own = _digits(m[0])
        if 16 <= len(own) <= 19 and _luhn(own):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


# Generators of candidates: wider than the base patterns, overlapping, most of them wrong.
_AT = re.compile(r"@|[(\[] ?at ?[)\]]| at (?=[A-Za-z0-9-]{1,63} dot )", re.IGNORECASE)
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?\Z")
_HOST = re.compile(r" ?[A-Za-z0-9-]{1,63}(?:(?:\.| ?[(\[] ?dot ?[)\]] ?| dot )[A-Za-z0-9-]{1,63}){1,6}", re.IGNORECASE)
_NUMBER = re.compile(r"(?<![0-9])(?:\+|\()?[0-9](?:[ ().\-/]{0,2}[0-9]){6,30}(?![0-9])")
_QUAD = re.compile(r"(?<![0-9])[0-9]{1,3}(?: ?[.:_-] ?[0-9]{1,3}){3}(?![0-9])")
_NAMES = {
    "mail": ("mail", "contact", "write", "correo"), "phone": ("phone", "tel", "call", "fax", "mobile"),
    "card": ("card", "visa", "credit", "karte", "tarjeta", "carte"), "net": ("ip", "host", "server", "addr", "from"),
    "number": ("order", "invoice", "id", "no.", "number", "date", "version", "isbn"),
}


def candidates(text: str) -> list[Span]:
    found: list[Span] = []
    lowered_at = "@" in text or "(at" in text or "[at" in text or " dot " in text or "(AT" in text or "[AT" in text
    for m in _AT.finditer(text) if lowered_at else ():
        name = _LOCAL.search(text, max(0, m.start() - 65), m.start())
        host = _HOST.match(text, m.end())
        if name and host:
            found.append(("email", name.start(), host.end()))
    if _DIGIT.search(text):
        for m in _NUMBER.finditer(text):
            n = len(_digits(m[0]))
            if n <= 15:
                found.append(("phone", *m.span()))
            if n >= 13:
                found.append(("card", *m.span()))
        found += [("ip", *m.span()) for m in _QUAD.finditer(text)]
    return found


def _side(c: str) -> int:
    return 0 if not c or c.isspace() else 1 if c.isalpha() else 2 if c.isdigit() else 3


def features(text: str, span: Span) -> list[float]:
    kind, start, end = span
    own = text[start:end]
    digits = _digits(own)
    groups = re.findall(r"[0-9]+", own)
    sizes = [len(g) for g in groups] or [0]
    before = text[max(0, start - 24):start].lower()
    return [
        KINDS.index(kind), len(own), len(digits), sum(c.isalpha() for c in own), own.count(" "), own.count("."), own.count("-"),
        own.count("/"), own.count("(") + own.count("["), own.startswith("+"), own.count("@"), len(groups), max(sizes), min(sizes),
        sizes[0], sizes[-1], bool(digits) and _luhn(digits), len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups),
        len(set(digits)), _side(text[start - 1:start]), _side(text[end:end + 1]), "dot" in own.lower(),
        *[any(x in before for x in names) for names in _NAMES.values()]]


def _disguised(kind: str, own: str) -> str | None:
    """A validated span written as people hide or vary it: what the base patterns miss."""
    if kind == "email":
        name, _, host = own.partition("@")
        return f"{name} (at) {host.replace('.', ' dot ')}"
    if kind == "card":
        d = _digits(own)
        return ".".join(d[i:i + 4] for i in range(0, len(d), 4))
    if kind == "phone":
        return own[own.find("("):] if "(" in own else None
    return None


def training_rows(texts: list[str], seed: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, labels, fold) from texts, without labels made by people.

    A candidate is right if it is a validated base span. Right too are disguised forms of such spans put in
    their places, and wrong are dates, versions, decimals and digits that fail their check there.
    Rows of one text share a fold of 0, 1, 2.
    """
    rng = random.Random(seed)
    x, y, fold = [], [], []

    def add(text, label, own_fold):
        right = {s: True for s in base_spans(text)} if label is None else {}
        for span in candidates(text):
            x.append(features(text, span))
            y.append(float(right.get(span, False)) if label is None else float(label == span))
            fold.append(own_fold)

    for i, text in enumerate(texts):
        add(text, None, i % 3)
        for kind, start, end in base_spans(text):
            before, after = text[max(0, start - 40):start], text[end:end + 40]
            hidden = _disguised(kind, text[start:end])
            if hidden:
                add(before + hidden + after, (kind, len(before), len(before) + len(hidden)), i % 3)
            d = [rng.randint(0, 9) for _ in range(16)]
            number = "".join(map(str, d))
            number = number[:-1] + str((d[-1] + 1) % 10) if _luhn(number) else number
            day = f"{rng.randint(1950, 2030)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02} {rng.randint(0, 23):02}.{rng.randint(0, 59):02}"
            wrong = [number, day, f"{d[0]}.{d[1]}{d[2]}.{d[3]}.{rng.randint(256, 999)}", f"{rng.randint(10**6, 10**9)}.{d[5]}{d[6]}",
                     f"{rng.randint(10**8, 10**12)}"]
            add(before + rng.choice(wrong) + after, ("", 0, 0), i % 3)
    return np.array(x, dtype=float).reshape(len(x), len(x[0]) if x else 0), np.array(y), np.array(fold, dtype=int)


class Detector:
    """Boosted trees and a threshold for each kind, calibrated on rows the trees have not seen."""

    def __init__(self, texts: list[str], precision: float = PRECISION):
        x, y, fold = training_rows(texts)
        self.trees, self.least = None, dict.fromkeys(KINDS, 2.0)
        train = fold > 0
        if len(y) and 0 < y[train].sum() < train.sum():
            self.trees = BoostedTrees().fit(x[train], y[train])
            p = self.trees.probability(x[~train])
            for k, kind in enumerate(KINDS):
                own = x[~train][:, 0] == k
                self.least[kind] = max(0.5, threshold_for(p[own], y[~train][own], precision))

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """Accepted candidates that touch no base span, the likeliest first where they overlap."""
        own = [s for s in candidates(text) if not any(s[1] < b[2] and b[1] < s[2] for b in base)]
        if self.trees is None or not own:
            return []
        p = self.trees.probability(np.array([features(text, s) for s in own], dtype=float))
        chosen: list[Span] = []
        for i in sorted(range(len(own)), key=lambda i: (-p[i], own[i][1], own[i][0])):
            s = own[i]
            if p[i] >= self.least[s[0]] and not any(s[1] < c[2] and c[1] < s[2] for c in chosen):
                chosen.append(s)
        return chosen


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2])))


_RESULT = "struct<base:string,spans:string,n_email:bigint,n_ip:bigint,n_card:bigint,n_phone:bigint,base_sha256:string>"


def find(text: Column, detector: Detector) -> Column:
    @F.arrow_udf(T._parse_datatype_string(_RESULT))
    def spans(texts: pa.Array) -> pa.Array:
        out = []
        for value in texts:
            own = value.as_py() or ""
            base = base_spans(own)
            line = joined(base)
            counts = {f"n_{k}": sum(s[0] == k for s in base) for k in KINDS}
            out.append({"base": line, "spans": joined(base + detector.added(own, base)), **counts,
                        "base_sha256": hashlib.sha256(line.encode()).hexdigest()})
        return pa.array(out, pa.struct([("base", pa.string()), ("spans", pa.string()), *[(f"n_{k}", pa.int64()) for k in KINDS],
                                        ("base_sha256", pa.string())]))

    return spans(text)


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE_DOCS) -> DataFrame:
    """(key, base, spans, n_email, n_ip, n_card, n_phone, base_sha256) for each row of `docs`.

    Spans are kind:start:end in code points, in order of kind and start, joined by commas; `base`
    has those of the base patterns, which the counts and the digest are of, and `spans` has also the
    candidates that the trees accept.

    The trees learn from at most `sample` documents with a digit or an at sign, chosen by a hash of the
    key, and then see every document; no shuffle of texts. NULL text is empty; NULL keys are kept;
    repeated rows get equal results; where the sample has no base span, nothing is added; an empty table gives
    no rows.
    """
    own = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    picked = hashed_sample(own.where(F.col("text").rlike("[0-9@]")), sample, F.col("key"), seed=3)
    detector = Detector([r[0] for r in picked.orderBy("key", "text").select("text").collect()])
    return own.withColumn("_found", find(F.col("text"), detector)).select(F.col("key").alias(key), "_found.*")


def redacted(text: str, spans: str) -> str:
    """`text` with each of `spans` replaced by its kind in brackets."""
    for kind, start, end in sorted((s.split(":") for s in spans.split(",") if s), key=lambda x: -int(x[1])):
        text = f"{text[:int(start)]}[{kind}]{text[int(end):]}"
    return text


@query("op3_pii")
def op3(spark, sf_dir):
    found = personal_data(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
