"""Secret scans by assignment-aware lexing.

Three plain patterns (assignments to a few names, access keys, long hex runs)
give the base spans.  On top of them the text is lexed as source or
configuration: statements ``name = literal``, ``name: literal``,
``"name": literal``, ``<name>literal</name>`` and ``name = other`` become
name-literal pairs; constants are propagated through names and concatenations,
so a literal is scored by the most sensitive name it ever reaches.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.steps import holds

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
#: Kinds of spans in the order in which they are listed.
KINDS = ("assign", "access", "hex", "named", "flow")

#: Parts of names and what each says about the value.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0,
             "credential": 0.9, "credentials": 0.9, "auth": 0.7, "key": 0.6, "pass": 0.8, "signature": 0.6, "salt": 0.6}
#: Literals that stand in for a secret.
PLACEHOLDER = re.compile(r"(?i)^(?:changeme|change_me|example|placeholder|redacted|dummy|test|none|null|true|false|undefined|your.*|x+|\*+|\.+|<.*|\$.*|\{.*|%.*)$")
#: Scores from which a literal is reported.
LEAST_SCORE = 0.7

_HINT = ("pass", "pwd", "secret", "token", "key", "cred", "auth", "signature", "salt")
_BASE_HINT = ("password", "passwd", "secret", "token", "api")
_RUN, _NAME = re.compile(r"[\w.-]+"), re.compile(r"[A-Za-z_]")
_ASSIGNED = re.compile(r"""["']?[ \t]*+(?::=|=>|[:=])[ \t]*+(?=[^\s=])""")
_TAG = re.compile(r"<(?P<name>[A-Za-z_][\w.-]*)>(?P<value>[^<>\n]+)</(?P=name)>")
_VALUE = re.compile(r"""[ \t]*(?:"(?P<d>[^"\n]*)"|'(?P<s>[^'\n]*)'|\$\{?(?P<v>[A-Za-z_]\w*)\}?|(?P<w>[^\s"'`,;(){}\[\]<>+]+))[ \t]*(?P<plus>\+)?""")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the plain patterns' matches, per kind leftmost and
    without overlap; matches that are too short are dropped after matching."""
    out, low = [], text.lower()
    if any(h in low for h in _BASE_HINT):
        out += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return out


def name_score(name: str) -> float:
    """How sensitive the name is: its most sensitive part, a little less if
    that part is not the last (``token_count`` holds no token); not at all if it
    is public."""
    parts = [p.lower() for p in _PART.findall(name)]
    if "public" in parts:
        return 0.0
    scores = [SENSITIVE.get(p, 0.0) * (1.0 if i == len(parts) - 1 else 0.75) for i, p in enumerate(parts)]
    pairs = ("".join(parts[i:i + 2]) for i in range(len(parts) - 1))
    return max([0.0, *scores, *(SENSITIVE.get(p, 0.0) for p in pairs)])


def literal_score(value: str) -> float:
    """How much the literal looks like a secret: from 0 for placeholders, short
    or spaced text to 1 for long values of many different characters."""
    if len(value) < 8 or " " in value or "\t" in value or PLACEHOLDER.match(value):
        return 0.0
    n = len(value)
    bits = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    classes = sum(any(f(c) for c in value) for f in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    return min(1.0, 0.3 + 0.12 * classes + 0.1 * max(0.0, bits - 1.5))


def statements(text: str) -> Iterator[tuple[int, str, int]]:
    """(start, name, start of the value) of everything that reads as an
    assignment.  A name lasts to the end of its run of name characters, so each
    run is looked at once, however long it is."""
    for run in _RUN.finditer(text):
        first = _NAME.search(text, run.start(), run.end())
        if first and (m := _ASSIGNED.match(text, run.end())):
            yield first.start(), text[first.start():run.end()], m.end()


def lexed(text: str) -> tuple[list[tuple[str, int, int]], dict[str, set[str]]]:
    """(name, start, end) of every literal that is assigned to a name itself, and
    for each name the names that it is assigned to."""
    out: list[tuple[str, int, int]] = []
    into: dict[str, set[str]] = {}
    events = [(*x, False) for x in statements(text)]
    names, defined = {name for _, name, _, _ in events}, set()
    events += [(m.start(), m.group("name"), m.start("value"), True) for m in _TAG.finditer(text)]
    for _, name, at, tag in sorted(events):
        if tag:
            out.append((name, at, text.index("<", at)))
            continue
        while (m := _VALUE.match(text, at)) is not None:
            kind = m.lastgroup if m.lastgroup != "plus" else next(k for k in "dsvw" if m.group(k) is not None)
            if kind in "ds" or kind == "w" and m.group(kind) not in defined:
                out.append((name, *m.span(kind)))
            if kind in "vw" and m.group(kind) in names:
                into.setdefault(m.group(kind), set()).add(name)
            at = m.end()
            if not m.group("plus"):
                break
        defined.add(name)
    return out, into


def reached(names: set[str], into: dict[str, set[str]]) -> dict[str, float]:
    """For each name the highest score of a name that constants get to from it
    (itself included), whatever the order of the statements: from the most
    sensitive names backwards, each name is visited once."""
    back: dict[str, list[str]] = {}
    for name, targets in into.items():
        for to in targets:
            back.setdefault(to, []).append(name)
    best: dict[str, float] = {}
    for score, name in sorted(((name_score(n), n) for n in names | into.keys() | back.keys()), reverse=True):
        open_ = [name]
        while open_:
            n = open_.pop()
            if n not in best:
                best[n] = score
                open_.extend(back.get(n, ()))
    return best


def added_spans(text: str, base: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """Literals that reach a sensitive name, where no base span lies: directly
    (``named``), or with a higher score through other names (``flow``)."""
    low = text.lower()
    if not any(h in low for h in _HINT) or not (":" in text or "=" in text or "</" in text):
        return []
    literals, into = lexed(text)
    own = {n: name_score(n) for n in {x[0] for x in literals}}
    best = reached({*own}, into)
    found: dict[tuple[int, int], tuple[float, str]] = {}
    for name, start, end in literals:
        through = max((best[to] for to in into.get(name, ())), default=0.0)
        found[start, end] = max(found.get((start, end), (0.0, "")), (own[name], "named"), (through, "flow"))
    starts, furthest = [], [0]  # of the base spans, and the furthest end up to each
    for s, _, e in sorted(base):
        starts.append(s)
        furthest.append(max(furthest[-1], e))
    out = []
    for (s, e), (n, kind) in found.items():
        if n and furthest[bisect_left(starts, e)] <= s and (value := literal_score(text[s:e])) > 0 and 0.5 * n + 0.5 * value >= LEAST_SCORE:
            out.append((s, kind, e))
    return out


def scan(text: str) -> tuple[list[tuple[int, str, int]], list[tuple[int, str, int]]]:
    """Base spans and all spans, each by start and then kind."""
    order = lambda x: (x[0], KINDS.index(x[1]), x[2])
    base = sorted(base_spans(text), key=order)
    return base, sorted(base + added_spans(text, base), key=order)


def redact(text: str, mark: str = "[SECRET]") -> str:
    """The text with every span (overlapping ones as one) replaced by ``mark``."""
    out, at = [], 0
    for start, _, end in scan(text)[1]:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


def _written(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def find_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of every row of
    ``docs(doc_id, text)``, in one pass without a shuffle.

    Offsets count code points, ends are exclusive.  Null text counts as empty;
    a text without secrets has zero counts and an empty ``spans``; repeated rows
    are kept; other columns are not read."""

    def run(batches):
        holds("secrets")
        for b in batches:
            rows = []
            for t in b.column("text"):
                base, spans = scan(t.as_py() or "")
                n = Counter(kind for _, kind, _ in base)
                rows.append((n["assign"], n["access"], n["hex"], hashlib.sha256(_written(base).encode()).hexdigest(), _written(spans)))
            a, c, h, s, w = map(list, zip(*rows)) if rows else ([], [], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(a, pa.int64()), pa.array(c, pa.int64()), pa.array(h, pa.int64()), pa.array(s, pa.string()), pa.array(w, pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets in ``text`` replaced; ``n_chars``, if there, follows
    the new text; null texts stay null and all other columns as they are."""

    def run(batches):
        holds("secrets")
        for b in batches:
            text = pa.array([None if t is None else redact(t) for t in b.column("text").to_pylist()], pa.string())
            yield b.set_column(b.schema.get_field_index("text"), "text", text)

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return out
