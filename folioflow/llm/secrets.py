"""Secret scans (operator 4).

An Aho-Corasick automaton finds the keywords of all rules in one pass over the lowered text. A rule's expression is
matched at the place of a hit and nowhere else. What it finds is validated by the checksum that such a secret embeds,
where its format has one: CRC-32 in base 62, Base58Check, the length of the DER structure, the header of a JSON web
token. A candidate whose checksum fails is no secret. Each text is scanned whole.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.llm.shared import fresh, readable, without, worker_cache

#: Bits per character that the value of an assignment needs to look random.
MIN_ENTROPY = 3.0

_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
_LOWER = {c: c + 32 for c in range(65, 91)}


def crc62(body: str) -> str:
    """CRC-32 as six digits of base 62."""
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, digit = divmod(n, 62)
        out = _BASE62[digit] + out
    return out


def _crc_ok(value: str) -> bool:
    body = value.partition("_")[2]
    return crc62(body[:-6]) == body[-6:]


def _base58_ok(value: str) -> bool:
    n = 0
    for c in value:
        n = 58 * n + _BASE58.index(c)
    raw = n.to_bytes((n.bit_length() + 7) // 8, "big")
    return hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


def _jwt_ok(value: str) -> bool:
    head = value.partition(".")[0]
    try:
        found = json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (ValueError, binascii.Error):
        return False
    return isinstance(found, dict) and "alg" in found


def _pem_ok(value: str) -> bool:
    body = value.partition("-----\n")[2] or value.partition("-----")[2].partition("-----")[2]
    body = body.partition("-----END")[0]
    if ":" in body:  # encrypted, with headers: there is no structure to see
        return True
    try:
        raw = base64.b64decode("".join(body.split()), validate=True)
    except (ValueError, binascii.Error):
        return False
    if raw[:14] == b"openssh-key-v1":
        return True
    if len(raw) < 4 or raw[0] != 0x30:
        return False
    if raw[1] < 0x80:
        return len(raw) == raw[1] + 2
    n = raw[1] & 0x7F
    return len(raw) == int.from_bytes(raw[2 : 2 + n], "big") + 2 + n


def entropy(value: str) -> float:
    n = len(value)
    return -sum(k / n * math.log2(k / n) for k in Counter(value).values())


class Rule(NamedTuple):
    """pattern is matched at a keyword's place. Its group v, or else all of it, is the secret."""

    kind: str
    keywords: tuple[str, ...]
    pattern: re.Pattern
    valid: Callable[[str], bool] | None = None


RULES = (
    Rule("github_token", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(r"(?<![A-Za-z0-9])gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), _crc_ok),
    Rule("npm_token", ("npm_",), re.compile(r"(?<![A-Za-z0-9])npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), _crc_ok),
    Rule("extended_key", ("xprv",), re.compile(r"(?<![A-Za-z0-9])xprv[1-9A-HJ-NP-Za-km-z]{107}(?![A-Za-z0-9])"), _base58_ok),
    Rule("jwt", ("eyj",), re.compile(r"(?<![\w.-])eyJ[\w-]{8,}\.[\w-]{8,}\.[\w-]{16,}"), _jwt_ok),
    Rule("private_key", ("-----begin ",), re.compile(r"-----BEGIN ((?:[A-Z0-9]{1,20} ){0,4}PRIVATE KEY)-----[^-]*(?:-(?!----)[^-]*)*-----END \1-----"), _pem_ok),
    Rule("aws_key", ("akia", "asia"), re.compile(r"(?<![A-Za-z0-9])A[KS]IA[A-Z2-7]{16}(?![A-Za-z0-9])")),
    Rule("google_key", ("aiza",), re.compile(r"(?<![\w-])AIza[\w-]{35}(?![\w-])")),
    Rule("slack_token", ("xoxa-", "xoxb-", "xoxp-", "xoxr-", "xoxs-"), re.compile(r"(?<![\w-])xox[abprs]-[A-Za-z0-9-]{10,}")),
    Rule("stripe_key", ("sk_live_", "rk_live_"), re.compile(r"(?<![A-Za-z0-9])[sr]k_live_[A-Za-z0-9]{24,}")),
    Rule(
        "assignment",
        ("token", "secret", "passwd", "password", "api_key", "apikey", "api-key", "access_key", "private_key", "auth_key"),
        re.compile(r"(?i:[a-z]{3,8}[_-]?[a-z]{0,4})[\w-]{0,30}[\"'`]?\s{0,5}(?:=>|:=|[:=])\s{0,5}[\"'`]?(?P<v>[A-Za-z0-9+/_.~-]{16,}={0,2})"),
        lambda v: entropy(v) >= MIN_ENTROPY and any(map(str.isdigit, v)),
    ),
)
_CHECKED = {"github_token", "npm_token", "extended_key", "jwt", "private_key"}


class Found(NamedTuple):
    """Places are counted in characters. checksum: whether the format embeds one, which then held."""

    kind: str
    start: int
    end: int
    checksum: bool


def _automaton():
    """Keywords to their lengths and the numbers of their rules: a worker's next task has rules of its own."""
    cache = worker_cache()
    if "secrets" not in cache:
        import ahocorasick

        found = ahocorasick.Automaton()
        by_word: dict[str, list[int]] = {}
        for n, rule in enumerate(RULES):
            for word in rule.keywords:
                by_word.setdefault(word, []).append(n)
        for word, rules in by_word.items():
            found.add_word(word, (len(word), rules))
        found.make_automaton()
        cache["secrets"] = found
    return cache["secrets"]


def _placeholder(value: str) -> bool:
    """Whether value has the format of a secret with a checksum, and the checksum fails."""
    return any(r.kind in _CHECKED and r.pattern.fullmatch(value) and not r.valid(value) for r in RULES)


def scan(text: str | None) -> list[Found]:
    """The secrets of text by place. Of those that overlap, the one that starts first stays, of equal starts that of the
    earlier rule. A null or empty text has none."""
    if not text:
        return []
    low = text.lower()
    if len(low) != len(text):  # some letters grow when lowered
        low = text.translate(_LOWER)
    found = {}
    for last, (size, rules) in _automaton().iter(low):
        for n in rules:
            rule = RULES[n]
            if m := rule.pattern.match(text, last + 1 - size):
                group = "v" if "v" in rule.pattern.groupindex else 0
                value = m[group]
                if rule.valid and not rule.valid(value) or rule.kind == "assignment" and _placeholder(value):
                    continue
                found[m.start(group), n] = Found(rule.kind, *m.span(group), rule.kind in _CHECKED)
    out, end = [], 0
    for _, one in sorted(found.items()):
        if one.start >= end:
            out.append(one)
            end = one.end
    return out


def redacted(text: str | None, found: list[Found]) -> str | None:
    """text with each secret replaced by its kind in angle brackets."""
    if not found:
        return text
    parts, at = [], 0
    for one in found:
        parts += text[at : one.start], f"<{one.kind}>"
        at = one.end
    return "".join(parts) + text[at:]


def _findings(schema: pa.DataType, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(i, f, hashlib.sha256(t[f.start : f.end].encode()).hexdigest()) for i, t in enumerate(batch.column(1).to_pylist()) for f in scan(t)]
        ids = batch.column(0).take(pa.array([r[0] for r in rows], pa.int64()))
        columns = [pa.array([getattr(f, k) for _, f, _ in rows], kind) for k, kind in (("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("checksum", pa.bool_()))]
        names = [batch.schema.names[0], "kind", "start_pos", "end_pos", "checksum", "sha256"]
        yield pa.RecordBatch.from_arrays([ids, *columns, pa.array([h for *_, h in rows], pa.string())], names=names)


def findings(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id_col, kind, start_pos, end_pos, checksum, sha256): a row for each secret of each row of docs, never the secret.

    sha256 is that of the secret. Bytes that are no UTF-8 count as replacement characters. Rows with a null or empty text give none; a null id is carried; repeated rows give
    repeated findings; other columns are not carried. An empty table gives no rows.
    """
    columns = docs.select(F.col(f"`{id_col}`"), readable(F.col(f"`{text}`")).alias(text))
    kinds = "kind string, start_pos int, end_pos int, checksum boolean, sha256 string"
    schema = T.StructType([columns.schema.fields[0], *T._parse_datatype_string(kinds).fields])
    return columns.mapInArrow(lambda x: _findings(None, x), schema)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of docs with secrets replaced in the text, and n_secrets, how many there were.

    Null and empty texts stay as they are, with n_secrets 0. Bytes that are no UTF-8 become replacement characters. A column n_chars, if there is one, gets the new length where
    the text changed. All rows stay, repeated ones too. A column named n_secrets, in any case of letters, is replaced.
    """
    docs = without(docs, "n_secrets")
    (done,) = fresh(docs, "done")

    @F.pandas_udf("t string, n int")
    def clean(texts):
        import pandas as pd

        out = [(t, scan(t)) for t in texts]
        return pd.DataFrame({"t": [redacted(t, f) for t, f in out], "n": [len(f) for _, f in out]})

    rows = docs.withColumn(done, clean(readable(F.col(f"`{text}`"))))
    new = {text: F.col(f"{done}.t")}
    for c in docs.columns:
        if c.lower() == "n_chars" and c != text:
            new[c] = F.when(F.col(f"{done}.n") > 0, F.length(f"{done}.t").cast(docs.schema[c].dataType)).otherwise(F.col(f"`{c}`"))
    return rows.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns], F.col(f"{done}.n").alias("n_secrets"))
