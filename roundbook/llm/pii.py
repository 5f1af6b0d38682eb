"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits,
URL schemes and identifier cues. A local parser per kind grows each anchor to
its boundaries and validates it; text without anchors costs only the pass.

Base kinds, leftmost and non-overlapping within a kind: ``email``, ``ip``,
``card``, ``phone``. Added kinds: ``url`` (scheme), ``account`` (IBAN that
passes its check digits, or a digit group behind an account cue) and
``secret`` (a long token of letters and digits behind a key cue).
"""

from __future__ import annotations

import re

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "account", "secret")
SPANS = "array<struct<kind:string,start:int,end:int>>"

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_URL = re.compile(r"[^\s<>\"'{}|\\^`]+")
_GAP = re.compile(r"[\s:=#\"'.-]{1,6}(?:(?:no|nr|number)[\s:=#\"'.-]{1,4})?", re.IGNORECASE)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_NUMBER = re.compile(r"[0-9](?:[\x20-]?[0-9]){5,33}(?![A-Za-z0-9])")
_TOKEN = re.compile(r"[A-Za-z0-9_\-+/]{16,}={0,2}")
_SCHEMES = ("http://", "https://", "ftp://")
_ACCOUNT_CUES = ("iban", "account", "acct", "konto", "compte", "cuenta", "ssn")
_SECRET_CUES = ("token", "secret", "password", "passwd", "api_key", "apikey", "api key", "access_key")


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    anchors = [("@", "email"), ("+", "phone"), *((d, "digit") for d in "0123456789")]
    for kind, cues in (("url", _SCHEMES), ("account", _ACCOUNT_CUES), ("secret", _SECRET_CUES)):
        anchors += [(form, kind) for cue in cues for form in {cue, cue.upper(), cue.capitalize()}]
    for word, kind in anchors:
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


_ANCHORS = _automaton()


def _luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


def _iban(text: str) -> bool:
    moved = text[4:] + text[:4]
    return 15 <= len(text) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def find(text: str | None) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) by start, then kind; code points, end exclusive."""
    if not text:
        return []
    out: list[tuple[str, int, int]] = []
    done = dict.fromkeys(KINDS, 0)  # where the last match of a kind ended, kept or not
    run_end = -1
    for last, (kind, n) in _ANCHORS.iter(text):
        start = last + 1 - n
        if kind == "digit":
            if start == run_end:  # further digits of a run change nothing
                run_end += 1
                in_run = True
            else:
                run_end = start + 1
                in_run = False
            if start >= done["ip"] and (not in_run or start == done["ip"]) and (m := _IP.match(text, start)):
                done["ip"] = m.end()
                if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
                    out.append(("ip", start, m.end()))
            if start >= done["card"] and (m := _CARD.match(text, start)):
                done["card"] = m.end()
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    out.append(("card", start, m.end()))
        elif kind == "email":
            left, floor = start, done["email"]
            while left > floor and text[left - 1] in _LOCAL:
                left -= 1
            if left < start and (m := _DOMAIN.match(text, start + 1)):
                done["email"] = m.end()
                out.append(("email", left, m.end()))
        elif start < done[kind]:
            continue
        elif kind == "phone":
            if m := _PHONE.match(text, start):
                done["phone"] = m.end()
                if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
                    out.append(("phone", start, m.end()))
        elif kind == "url":
            if m := _URL.match(text, last + 1):
                end = last + 1 + len(m[0].rstrip(".,;:!?)]"))
                if end > last + 1:
                    out.append(("url", start, end))
                done["url"] = m.end()
        elif gap := _GAP.match(text, last + 1):
            at = gap.end()
            if kind == "secret":
                m = _TOKEN.match(text, at)
                good = m and any(c.isdigit() for c in m[0])
            elif m := _IBAN.match(text, at):
                good = _iban(m[0].replace(" ", ""))
            else:
                m = good = _NUMBER.match(text, at)
            if good:
                out.append((kind, at, m.end()))
                done[kind] = m.end()
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def spans(text: Column | str) -> Column:
    """The spans of a text column; none for null and empty texts."""

    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in find(t)] for t in texts])

    return F.pandas_udf(of, SPANS)(text)


def redacted(text: str | None) -> str | None:
    """The text with each span, overlapping ones merged, as ``[KIND]``."""
    if not text:
        return text
    out, at = [], 0
    merged: list[list] = []
    for kind, a, b in find(text):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([kind, a, b])
    for kind, a, b in merged:
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with its text redacted; rows and other columns stay as they are."""

    def of(texts: pd.Series) -> pd.Series:
        return texts.map(redacted, na_action="ignore")

    return docs.withColumn(text, F.pandas_udf(of, "string")(F.col(text)))


def report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans) per row. Null and empty texts have no spans; repeated
    rows and null ids are reported as they come; other columns are not read."""
    return docs.select(F.col(doc_id).alias("doc_id"), spans(F.col(text)).alias("spans"))
