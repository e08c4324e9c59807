"""Secret scan: fixed patterns, and assignment-aware lexing.

The patterns find the base spans.  The lexer reads names, literals and
operators of source and configuration syntax, forms name-literal pairs (an
assignment, also to a subscript, a mapping entry, a keyword argument, the
literals of a list or call, a block scalar, a markup element), follows names that stand
for an earlier constant and joins concatenated literals; a literal is a
secret if its own or a propagated name is sensitive and its characters look
random enough.  Work and memory are linear in a text.

Defined results: null and empty texts have no spans; repeated rows are
scanned each; an empty table gives an empty result; other columns are never
read (``redacted`` returns them unchanged).
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from elcorpus.llm.common import keyed, ship

#: Fixed patterns; the kinds in their order of listing.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "literal")
ASSIGN_LEAST = 6

#: Words of names that mark what they hold as sensitive, and how strongly.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 1.0, "secret": 1.0, "token": 1.0, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "bearer": 0.9, "auth": 0.7, "key": 0.6, "private": 0.6, "signature": 0.6, "salt": 0.6, "pass": 0.6, "access": 0.4, "api": 0.4, "session": 0.4, "cookie": 0.4}
THRESHOLD = 1.0
LITERAL_LEAST = 8

_NAME = r"[A-Za-z_][A-Za-z0-9_.-]*"
_OTHERS = r"""(?P<text>\"{3}(?:[^"]|"(?!"")){0,4096}+\"{3}|'{3}(?:[^']|'(?!'')){0,4096}+'{3}|"(?:[^"\\\n]|\\.){0,4096}+"|'(?:[^'\\\n]|\\.){0,4096}+'|`[^`\n]{0,4096}+`)|(?P<op>:=|=>|[:=+,;(){}\[\]])|(?P<line>\n)"""
_LEX = re.compile(rf"(?P<name>{_NAME})|{_OTHERS}|(?P<bare>[0-9][A-Za-z0-9+/_.=-]*)")
#: Where a value is due: literals of any length without white space (others
#: are no keys), and unquoted runs whole.
_VALUE = re.compile(rf"""(?P<long>"[^"\\\s]++"|'[^'\\\s]++')|(?P<run>[A-Za-z0-9+/_.-][A-Za-z0-9+/_.=-]*+)|{_OTHERS}""")
_NAME_CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-"
#: A quoted key with white space of more characters is prose.
KEY_MOST = 130
_ELEMENT = re.compile(rf"<({_NAME})>\s*+([^<>\s]++)\s*+</\1>")
_BLOCK = re.compile(rf"^( *+)(?:- *+)?({_NAME}) *+: *+[|>][+-]? *+\n", re.MULTILINE)
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_PAIR = re.compile(r"[:=]>?\s*(?:[\"'`(\[A-Za-z0-9_+/.-])")


def sensitivity(name: str) -> float:
    """How sensitive a name is: the sum over its words, at most 1.2."""
    words = [w.lower() for w in _WORD.findall(name)]
    joined = {a + b for a, b in zip(words, words[1:], strict=False)}
    return min(1.2, sum(SENSITIVE.get(w, 0.0) for w in {*words, *joined}))


def randomness(literal: str) -> float:
    """From 0 (one character, plain words) to 1 (like a random key)."""
    return _randomness(Counter(literal)) if len(literal) >= LITERAL_LEAST else 0.0


def _randomness(chars: dict[str, float]) -> float:
    n = sum(chars.values())
    if n < LITERAL_LEAST or any(c.isspace() for c in chars):
        return 0.0
    entropy = -sum(c / n * math.log2(c / n) for c in chars.values())
    kinds = len({"a" if "a" <= c <= "z" else "A" if "A" <= c <= "Z" else "0" if "0" <= c <= "9" else "_" for c in chars})
    return min(1.0, entropy / math.log2(min(n, 64))) * (0.35 + 0.2 * min(kinds, 3) + 0.05 * (n >= 16))


class Constant:
    """A literal with its place, or joined constants, which are shared."""

    __slots__ = ("place", "text", "parts", "counts", "tried")

    def __init__(self, start: int = 0, end: int = 0, text: str = "", parts: tuple[Constant, ...] = ()):
        self.place, self.text, self.parts, self.tried = (start, end), text, parts, 0.0
        self.counts = None
        if parts:
            self.counts = Counter()
            for p in parts:
                for c, k in p.chars().items():
                    self.counts[c] += k
            if sum(self.counts.values()) > 1e12:  # doubled again and again: only shares matter
                self.counts = Counter({c: k * 1e-6 for c, k in self.counts.items() if k > 1e-100})

    def chars(self) -> Counter:
        if self.counts is None:
            self.counts = Counter(self.text)
        return self.counts

    def report(self, score: float, out: set) -> None:
        """Add the places of all literals if the whole looks random enough,
        else of the parts that do; none is visited twice for one score."""
        wait = [(self, False)]
        while wait:
            one, whole = wait.pop()
            if one.tried >= (9.0 if whole else score):
                continue
            whole = whole or score + (_randomness(one.counts) if one.counts is not None else randomness(one.text)) >= THRESHOLD + 0.4
            one.tried = 9.0 if whole else score
            if whole and not one.parts:
                out.add((one.place[0], 3, one.place[1]))
            wait += [(p, whole) for p in one.parts]


def literals(text: str) -> Iterator[tuple[str, Constant]]:
    """(name, constant) pairs, propagated ones included."""
    known: dict[str, Constant] = {}
    name, value, spans = None, None, []
    last = None  # the name before an operator
    inside = 0  # brackets open in the value: lists, calls, literals side by side

    def done():
        if name is not None and spans:
            known[name] = spans[0] if len(spans) == 1 else Constant(parts=tuple(spans))
            yield name, known[name]

    at = 0
    while m := (_VALUE if name is not None and value is None else _LEX).search(text, at):
        kind, tok, at = m.lastgroup, m.group(), m.end()
        if kind == "op" and tok in (":=", "=>", ":", "="):
            if last is not None:
                yield from done()
                name, spans, value, inside = last, [], None, 0
            last = None
        elif kind == "op" and tok in "([" and name is not None and (value is None or tok == "(" and not spans and text[m.start() - 1] not in " \t"):
            inside, value, last = inside + 1, None, None
        elif inside and (kind == "line" or kind == "op" and tok in ",)]"):
            if kind == "op":
                yield from done()
                spans, last = [], None
                inside -= tok != ","
                if not inside:
                    name = None
        elif kind == "op" and tok == "]" and name is None:
            pass  # a subscript: its literal is the name
        elif inside and kind in ("run", "name", "bare") and "=" not in tok:
            if tok in known:
                spans.append(known[tok])
            last = _tail(tok)
        elif kind == "op" and tok == "+":
            value = None
        elif kind in ("line", "op"):
            yield from done()
            name, spans, last, value, inside = None, [], None, None, 0
        elif kind == "run":
            if not any(c.isalnum() or c == "_" for c in tok):
                continue
            pieces = tok.split("+")
            if len(pieces) > 1 and any(p in known for p in pieces):  # constants joined
                place = m.start()
                for p in pieces:
                    if p in known:
                        spans.append(known[p])
                    elif any(c.isdigit() for c in p):
                        spans.append(Constant(place, place + len(p), p))
                    place += len(p) + 1
                value, last = tok if pieces[-1] else None, _tail(pieces[-1])
                continue
            value = tok
            if tok in known:  # a constant by its name
                spans.append(known[tok])
            elif any(c.isdigit() for c in tok):
                spans.append(Constant(m.start(), m.end(), tok))
            last = _tail(tok)
            if "=" in tok:  # assignments inside the run
                most, place = 0.0, m.start()
                parts = tok.split("=")
                for k, part in enumerate(parts[:-1]):
                    place += len(part) + 1
                    inner = _tail(part)
                    if inner is None:
                        continue
                    yield from done()
                    # the rest of the run for each more sensitive name, else the next part
                    how = sensitivity(inner)
                    end = m.end() if how > most else place + len(parts[k + 1])
                    most, own = max(most, how), text[place:end]
                    name, value, last, inside = inner, own or None, _tail(parts[-1]), 0
                    spans = [known[own]] if own in known else [Constant(place, end, own)] if any(c.isdigit() for c in own) else []
        elif kind in ("text", "long", "bare", "name"):
            if name is not None and value is None:
                value = None if inside else tok
                spans.append(_inner(text, m.start(), m.end()))
            last = None if kind == "bare" or len(tok) > KEY_MOST and len(tok.split(None, 1)) > 1 else tok.strip("\"'`")
    yield from done()


def _tail(run: str) -> str | None:
    """The name at a run's end."""
    return run[len(run.rstrip(_NAME_CHARACTERS)):].lstrip("0123456789.-") or None


def _inner(text: str, start: int, end: int) -> Constant:
    """The constant of a quoted literal: what lies in its quotes, in triple
    ones without white space at its ends."""
    quotes = 3 if end - start >= 6 and text[start:start + 3] in ('"""', "'''") else 1
    start, end = start + quotes, end - quotes
    if quotes == 3:
        start += len(text[start:end]) - len(text[start:end].lstrip())
        end = start + len(text[start:end].rstrip())
    return Constant(start, end, text[start:end])


def elements(text: str) -> Iterator[tuple[str, Constant]]:
    """(name, constant) of markup elements that hold one literal."""
    for m in _ELEMENT.finditer(text):
        yield m.group(1), Constant(m.start(2), m.end(2), m.group(2))


def blocks(text: str) -> Iterator[tuple[str, Constant]]:
    """(name, constant) of block scalars: the lines indented more than their
    name, joined."""
    at = 0
    while m := _BLOCK.search(text, at):
        at, parts = m.end(), []
        while at < len(text):
            end = text.find("\n", at)
            end = len(text) if end < 0 else end
            line = text[at:end]
            body = line.strip()
            place = at + len(line) - len(line.lstrip())
            if body and place - at <= len(m.group(1)):
                break
            if body:
                parts.append(Constant(place, place + len(body), body))
            at = end + 1
        if parts:
            yield m.group(2), parts[0] if len(parts) == 1 else Constant(parts=tuple(parts))


def spans_of(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place, end) of all spans, in order."""
    out = {(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST}
    out |= {(m.start(), 1, m.end()) for m in ACCESS.finditer(text)}
    out |= {(m.start(), 2, m.end()) for m in HEX.finditer(text)}
    scores: dict[str, float] = {}
    for name, constant in chain(literals(text) if _PAIR.search(text) else (), blocks(text), elements(text)):
        if name not in scores:
            scores[name] = sensitivity(name)
        if scores[name]:
            constant.report(scores[name], out)
    return sorted(out)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts by kind, digest of the base spans, all
    spans (code points, end exclusive)."""
    docs = keyed(documents, id_col, text_col).drop("row_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                spans = spans_of(text.as_py() or "")
                n = Counter(k for _, k, _ in spans)
                base = joined([s for s in spans if s[1] < 3])
                rows.append((n[0], n[1], n[2], hashlib.sha256(base.encode()).hexdigest(), joined(spans), n[3]))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_literal"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_literal long")


def redacted(documents: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``documents`` with a mark in place of every (merged) span."""
    ship(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = batch.column(at).to_pylist()
            for i, text in enumerate(texts):
                spans = spans_of(text) if text else []
                if spans:
                    out, end = [], 0
                    for a, _, b in spans:
                        if a >= end:
                            out += [text[end:a], mark]
                        end = max(end, b)
                    texts[i] = "".join([*out, text[end:]])
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return documents.mapInArrow(run, documents.schema)


