"""PII: anchors found by an Aho-Corasick automaton, expanded and checked by local parsers.

Anchors are at-signs, ``://``, plus signs, digits and identifier cues. Each kind's parser
looks only at the characters around its anchors, in one pass, so the work is linear however
long a text or a run of digits is.

Base kinds, leftmost and non-overlapping within a kind: email, ip, card, phone. Added kinds:
``address`` (a URL that carries a user name, or whose host is an IP address), ``account``
(a cue such as "iban" followed by an identifier; IBANs must pass their check sum) and ``secret``
(a cue such as "token" or "password", an equals sign or colon, and a value of letters and digits; keys
that are known by how they begin; private keys in text form).

Defined results: null text is the empty text; an empty table gives an empty result; repeated
rows and null ids are rows like any other; extra columns are kept by ``masked`` and ignored
by ``spans_of``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
ADDED = ("address", "account", "secret")
KINDS = BASE + ADDED

CUES = ("iban", "account", "acct", "passport", "ssn", "tax id")
SECRET_CUES = (
    "password", "passwd", "pwd", "passphrase", "token", "secret", "bearer", "credential", "credentials",
    "api key", "api_key", "api-key", "apikey", "access key", "access_key", "access-key", "auth key", "auth_key", "private_key")
# How well-known kinds of keys begin, and what follows.
SECRET_SHAPES = {
    "AKIA": r"[A-Z0-9]{16}", "ASIA": r"[A-Z0-9]{16}",
    "ghp_": r"[A-Za-z0-9]{36,}", "gho_": r"[A-Za-z0-9]{36,}", "ghs_": r"[A-Za-z0-9]{36,}",
    "xoxb-": r"[A-Za-z0-9-]{20,}", "xoxp-": r"[A-Za-z0-9-]{20,}",
    "eyJ": r"[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
}
#: A value after a cue has at least this many characters, a digit and a letter among them.
SECRET_LENGTH = 8
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_LABEL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-")
_KEY = _LABEL | {"_"}
_PHONE = frozenset(" ().0123456789-")
_DIGITS = frozenset("0123456789")

_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
_run = re.compile(r"[0-9]+").match
_phone_run = re.compile(r"[\x20().0-9-]+").match
_url_rest = re.compile(r"(?:[A-Za-z0-9._~%!$&'*+,;=:-]+@)?(?:[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)(?::[0-9]{1,5})?(?:/[^\s<>\"]*)?").match
_identifier = re.compile(
    r"(?: ?(?:number|no|nr)\b\.?)? ?[:#=]? ?"
    r"([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])|[0-9](?:[ -]?[0-9])+(?![A-Za-z0-9]))").match

_assigned = re.compile(r"[\"']?[\x20\t]{0,4}(?::=|=>|[:=])[\x20\t]{0,4}(?:Bearer[\x20])?[\"']?([A-Za-z0-9+/_.~!@#$%^*-]+=*)").match
_bearer = re.compile(r"[\x20]([A-Za-z0-9+/_.~-]{16,}=*)").match
_pem = re.compile(r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----").match
_pem_end = re.compile(r"-----END (?:[A-Z]+ )?PRIVATE KEY-----").search
_shape = {begin: re.compile(rest + r"(?![A-Za-z0-9_])").match for begin, rest in SECRET_SHAPES.items()}
_automaton = None


def automaton():
    """The anchors; one for each Python worker."""
    global _automaton
    if _automaton is None:
        import ahocorasick

        _automaton = ahocorasick.Automaton()
        for digit in _DIGITS:
            _automaton.add_word(digit, "digit")
        _automaton.add_word("@", "at")
        _automaton.add_word("+", "plus")
        _automaton.add_word("://", "scheme")
        for cue in CUES:
            for form in (cue, cue.upper(), cue.capitalize()):
                _automaton.add_word(form, "cue")
        for cue in SECRET_CUES:
            for form in (cue, cue.upper(), cue.capitalize()):
                _automaton.add_word(form, "secret")
        for begin in (*SECRET_SHAPES, "-----BEGIN "):
            _automaton.add_word(begin, "shape")
        _automaton.make_automaton()
    return _automaton


def anchors(text: str) -> dict[str, list[int]]:
    """For each kind of anchor, where its matches end (inclusive)."""
    found: dict[str, list[int]] = {"at": [], "plus": [], "scheme": [], "cue": [], "secret": [], "shape": [], "digit": []}
    for end, kind in automaton().iter(text):
        found[kind].append(end)
    return found


def emails(text: str, ats: list[int]) -> list[tuple[int, int]]:
    out, done = [], 0
    for at in ats:
        if at < done:
            continue
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _domain(text, at + 1)):
            out.append((start, domain.end()))
            done = domain.end()
        # A local part cannot hold an at-sign, so nothing left of it is read again.
        done = max(done, at + 1)
    return out


def digit_runs(text: str, digits: list[int]) -> list[tuple[int, int]]:
    out, end = [], -1
    for at in digits:
        if at != end:
            out.append((at, at + 1))
        else:
            out[-1] = (out[-1][0], at + 1)
        end = at + 1
    return out


def ips(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out, i = [], 0
    while i + 3 < len(runs):
        four = runs[i : i + 4]
        broken = next((j for j in range(3) if four[j + 1][0] != four[j][1] + 1 or text[four[j][1]] != "."), None)
        if broken is not None:
            i += broken + 1
            continue
        if all(len(part := text[a:b].lstrip("0")) <= 3 and int(part or 0) <= 255 for a, b in four):
            out.append((four[0][0], four[3][1]))
        i += 4
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def cards(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out, i = [], 0
    while i < len(runs):
        start, end = runs[i]
        size = end - start
        i += 1
        while i < len(runs) and runs[i][0] == end + 1 and text[end] in " -":
            size += runs[i][1] - runs[i][0]
            end = runs[i][1]
            i += 1
        if 14 <= size <= 19 and luhn("".join(c for c in text[start:end] if c in _DIGITS)):
            out.append((start, end))
    return out


def phones(text: str, pluses: list[int]) -> list[tuple[int, int]]:
    out = []
    for at in pluses:  # a match holds no second plus sign, so matches cannot overlap
        if text[at + 1 : at + 2] not in _DIGITS or not (run := _phone_run(text, at + 2)):
            continue
        end = run.end()
        while end > at + 2 and text[end - 1] not in _DIGITS:
            end -= 1
        if end < at + 4:
            continue
        if 10 <= sum(c in _DIGITS for c in text[at:end]) <= 15:
            out.append((at, end))
    return out


def addresses(text: str, schemes: list[int]) -> list[tuple[int, int]]:
    out, done = [], 0
    for at in schemes:
        start = at - 2
        while start > done and at - start < 20 and text[start - 1].isascii() and text[start - 1].isalpha():
            start -= 1
        if start == at - 2 or start < done or not (rest := _url_rest(text, at + 1)):
            continue
        place = rest.group().split("/", 1)[0]
        host = place.rpartition("@")[2].split(":")[0].split(".")
        if "@" in place or len(host) == 4 and all(h.isascii() and h.isdigit() and len(h) < 4 and int(h) < 256 for h in host):
            out.append((start, rest.end()))
            done = rest.end()
    return out


def iban(code: str) -> bool:
    code = code.upper()
    if not (15 <= len(code) <= 34 and code[:2].isalpha() and code[2:4].isdigit()):
        return False
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def accounts(text: str, cues: list[int]) -> list[tuple[int, int]]:
    out, done = [], 0
    for at in cues:
        if at < done or not (found := _identifier(text, at + 1, at + 81)):
            continue
        start, end = found.span(1)
        code = re.sub("[ -]", "", found[1])
        if iban(code) or code.isdigit() and 8 <= len(code) <= 17:
            out.append((start, end))
            done = end
    return out


def _value(found: re.Match) -> tuple[int, int] | None:
    """The span of a cue's value, without the stops that end a sentence; none if it looks like prose."""
    start, end = found.span(1)
    while end > start and found.string[end - 1] in ".!":
        end -= 1
    value = found.string[start:end]
    if len(value) < SECRET_LENGTH or not any(c in _DIGITS for c in value) or not any(c.isalpha() for c in value):
        return None
    return start, end


def secrets(text: str, cues: list[int], shapes: list[int]) -> list[tuple[int, int]]:
    """Cued values and keys of known shape, leftmost first, without overlaps. A private key ends with
    its last line, or with its first if no last one follows; that is searched for once at most in vain."""
    out, done, no_end = [], 0, False
    anchored = sorted([(at, True) for at in cues] + [(at, False) for at in shapes])
    for at, cued in anchored:
        if at < done:
            continue
        span = None
        if cued:
            found = _assigned(text, at + 1)
            if not found and text[at - 5 : at + 1].lower() == "bearer":
                found = _bearer(text, at + 1)
            span = _value(found) if found else None
        elif text[at - 10 : at + 1] == "-----BEGIN ":
            if head := _pem(text, at - 10):
                tail = None if no_end else _pem_end(text, head.end())
                no_end = tail is None
                span = at - 10, (tail or head).end()
        else:
            begin = next(b for b in SECRET_SHAPES if text.startswith(b, at + 1 - len(b)))
            start = at + 1 - len(begin)
            if (start == 0 or text[start - 1] not in _KEY) and (rest := _shape[begin](text, at + 1)):
                span = start, rest.end()
        if span and span[0] >= done:
            out.append(span)
            done = span[1]
    return out


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end exclusive), by start, then kind as listed."""
    found = anchors(text)
    runs = digit_runs(text, found["digit"])
    each = {
        "email": emails(text, found["at"]), "ip": ips(text, runs), "card": cards(text, runs),
        "phone": phones(text, found["plus"]), "address": addresses(text, found["scheme"]),
        "account": accounts(text, found["cue"]), "secret": secrets(text, found["secret"], found["shape"]),
    }
    return sorted(((k, a, b) for k in KINDS for a, b in each[k]), key=lambda x: (x[1], KINDS.index(x[0])))


def masked_text(text: str) -> str:
    """Each span replaced by its kind in angle brackets; overlapping spans become one, named
    after the first."""
    out, done = [], 0
    merged: list[list] = []
    for kind, a, b in spans_of(text):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([kind, a, b])
    for kind, a, b in merged:
        out += [text[done:a], f"<{kind.upper()}>"]
        done = b
    return "".join(out) + text[done:]


def with_spans(docs: DataFrame) -> DataFrame:
    """doc_id and ``spans``: array of (kind, start, end), in code points."""

    @F.pandas_udf("array<struct<kind string, start long, end long>>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in spans_of(t or "")] for t in batch])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       find(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("spans"))


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with the spans of ``text`` masked and ``n_chars`` renewed where there is one."""

    @F.pandas_udf("string")
    def mask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda t: None if t is None else masked_text(t))

    out = docs.withColumn("text", mask(F.col("text").cast("string")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out.select(*docs.columns)
