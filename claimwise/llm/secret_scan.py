"""Secret scan: keyword automaton, anchored patterns at its hits, checksums inside the found tokens."""

from __future__ import annotations

import base64
import hashlib
import json
import re
import string
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from claimwise.llm.frames import texts
from claimwise.llm.wordhash import slices

_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
_WORD = (string.ascii_letters + string.digits + "_").encode()
_BASE62 = (string.digits + string.ascii_uppercase + string.ascii_lowercase).encode()
_BASE58 = b"123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
_BECH32 = b"qpzry9x8gf2tvdw0s3jn54khce6mua7l"


def crc_digits(token: bytes) -> bool:
    """The last six base-62 digits are the CRC-32 of what stands between them and the prefix ``xxx_``."""
    crc, digits = zlib.crc32(token[4:-6]), b""
    for _ in range(6):
        crc, digit = divmod(crc, 62)
        digits = _BASE62[digit:digit + 1] + digits
    return digits == token[-6:]


def base58_sum(token: bytes) -> bool:
    """Base-58 text whose last four bytes start the double SHA-256 of the rest."""
    number = 0
    for c in token:
        number = number * 58 + _BASE58.index(c)
    raw = number.to_bytes(82, "big") if number < 1 << 656 else b""
    return len(raw) == 82 and hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


def bech32_sum(token: bytes) -> bool:
    """The six last characters after prefix and ``1`` make the polynomial of the whole one."""
    prefix, _, data = token.lower().rpartition(b"1")
    values = [c >> 5 for c in prefix] + [0] + [c & 31 for c in prefix] + [_BECH32.index(c) for c in data]
    check = 1
    for v in values:
        top = check >> 25
        check = (check & 0x1FFFFFF) << 5 ^ v
        for bit, generator in enumerate((0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)):
            check ^= generator if top >> bit & 1 else 0
    return check == 1


def key_body(block: bytes) -> bool:
    """A key block whose body decodes to one sequence of exactly its stated length, or to the open format."""
    try:
        raw = base64.b64decode(b"".join(block.split(b"-----")[2].split()), validate=True)
    except ValueError:
        return False
    if raw.startswith(b"openssh-key-v1\0"):
        return True
    if len(raw) < 2 or raw[0] != 0x30:
        return False
    wide = raw[1] - 0x80 if raw[1] > 0x80 else 0
    return len(raw) == 2 + wide + (int.from_bytes(raw[2:2 + wide], "big") if wide else raw[1])


def signed_header(token: bytes) -> bool:
    """The first part decodes to an object that names an algorithm."""
    head = token.split(b".")[0]
    try:
        header = json.loads(base64.urlsafe_b64decode(head + b"=" * (-len(head) % 4)).decode())
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and "alg" in header


class Rule(NamedTuple):
    """A kind of secret: what stands at its start in lower case, its pattern from there on, and its checks.

    ``alone`` asks that no word character stands before. ``part`` is the group that
    needs ``least`` characters.
    """

    kind: str
    keywords: tuple[str, ...]
    pattern: str
    least: int = 1
    part: int = 0
    valid: Callable[[bytes], bool] | None = None
    alone: bool = False


#: Fixed kinds, in their order. The last one has no keyword: a run of its class is the near hit.
BASE = (
    Rule("assign", ("password", "passwd", "secret", "token", "apikey", "api_key"),
         r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", ("akia",), r"AKIA[A-Z0-9]+", 20),
    Rule("hex", (), r"[0-9a-f]+", 24),
)

#: Token formats that carry a checksum or state their own length. Callers may pass others.
CHECKED = (
    Rule("code-host", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9_])", valid=crc_digits, alone=True),
    Rule("package-host", ("npm_",), r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9_])", valid=crc_digits, alone=True),
    Rule("wallet", ("xprv", "yprv", "zprv"), r"[xyz]prv[1-9A-HJ-NP-Za-km-z]{107}(?![A-Za-z0-9_])", valid=base58_sum, alone=True),
    Rule("age-key", ("age-secret-key-1",), r"AGE-SECRET-KEY-1[QPZRY9X8GF2TVDW0S3JN54KHCE6MUA7L]{58}(?![A-Za-z0-9_])", valid=bech32_sum, alone=True),
    Rule("note-key", ("nsec1",), r"nsec1[qpzry9x8gf2tvdw0s3jn54khce6mua7l]{58}(?![A-Za-z0-9_])", valid=bech32_sum, alone=True),
    Rule("signed-token", ("eyj",), r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", valid=signed_header, alone=True),
    Rule("private-key", ("-----begin ",), r"-----BEGIN ((?:RSA |EC |DSA |OPENSSH |ENCRYPTED )?PRIVATE KEY)-----[A-Za-z0-9+/=\s]+-----END \1-----", valid=key_body),
)


class Scanner:
    """Rules compiled for the texts of a slice."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.patterns = [re.compile(r.pattern.encode()) for r in rules]
        where: dict[str, list[int]] = {}
        for number, rule in enumerate(rules):
            for word in rule.keywords:
                where.setdefault(word, []).append(number)
        self.automaton = ahocorasick.Automaton()
        for word, numbers in where.items():
            self.automaton.add_word(word, (len(word), numbers))
        if where:
            self.automaton.make_automaton()
        # a rule without keyword is a class of characters: the bytes it takes, and as many of them as it needs
        self.classes = []
        for number, rule in enumerate(rules):
            if not rule.keywords:
                inside = bytes(b for b in range(256) if self.patterns[number].fullmatch(bytes([b])))
                table = bytes(1 if b in inside else 0 for b in range(256))
                self.classes.append((number, table, b"\1" * rule.least))

    def find(self, data: bytes, off: list[int]) -> Iterator[tuple[int, int, int, int]]:
        """``(text, rule, start, end)`` in bytes of the slice; per rule leftmost first and without overlap."""
        reached = [0] * len(self.rules)
        if len(self.automaton):
            for last, (length, numbers) in self.automaton.iter(data.translate(_LOWER).decode("latin-1")):
                start = last - length + 1
                text = bisect_right(off, start) - 1
                for number in numbers:
                    if start >= reached[number]:
                        hit = self.patterns[number].match(data, start, off[text + 1])
                        if hit:
                            # a match that fails its checks has taken its characters too
                            reached[number] = hit.end()
                            if self._holds(self.rules[number], hit, data, off[text]):
                                yield text, number, start, hit.end()
        for number, table, run in self.classes:
            flags, at = data.translate(table), 0
            while (at := flags.find(run, at)) >= 0:
                text = bisect_right(off, at) - 1
                hit = self.patterns[number].match(data, at, off[text + 1])
                if self._holds(self.rules[number], hit, data, off[text]):
                    yield text, number, at, hit.end()
                at = hit.end()

    @staticmethod
    def _holds(rule: Rule, hit: re.Match, data: bytes, first: int) -> bool:
        if len(hit[rule.part]) < rule.least or (rule.alone and hit.start() > first and data[hit.start() - 1] in _WORD):
            return False
        return rule.valid is None or rule.valid(hit[0])


def _scanned(batches: Iterator[pa.RecordBatch], rules: tuple[Rule, ...], span: pa.DataType) -> Iterator[pa.RecordBatch]:
    scanner = Scanner(rules)
    for batch in batches:
        for low, high, data, off in slices(batch.column(1)):
            spans: list[list[tuple[int, int, int]]] = [[] for _ in range(high - low)]
            for text, number, start, end in scanner.find(data.tobytes(), off.tolist()):
                spans[text].append((start, number, end))
            out = []
            for text, own in enumerate(spans):
                # code points before each byte of a text that has a find
                before = np.concatenate([[0], np.cumsum(data[off[text]:off[text + 1]] & 0xC0 != 0x80)]) if own else None
                out.append([{"kind": rules[number].kind, "start": int(before[start - off[text]]), "stop": int(before[end - off[text]])}
                            for start, number, end in sorted(own)])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array(out, span)], names=["doc_id", "spans"])


def secret_scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: tuple[Rule, ...] = BASE, checked: tuple[Rule, ...] = CHECKED,
) -> DataFrame:
    """``doc_id, spans``: one row per text with its secrets, ``spans`` as ``kind, start, stop`` in code points.

    An automaton of all keywords passes over the lower-cased bytes once; only at its hits
    is the anchored pattern of the rule tried, or, for a rule without keyword, where as many
    bytes of its class follow one another as it needs. Matches of one rule do not overlap, the leftmost
    counts; one that is too short or fails its checksum is dropped, but its characters are used
    up. Spans are sorted by start, then by the order of the rules.

    A map over texts without shuffle. Null and empty texts have no spans; texts of any length
    are scanned whole, a slice of about a megabyte or one longer text at a time; finds
    at the same place are kept once per kind (ties have the order of the rules); repeated rows give repeated
    results, an empty table none; null ids stay null; other columns are ignored.
    """
    rules = (*base, *checked)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
    return texts(docs, id_col, text_col).mapInArrow(
        lambda it: _scanned(it, rules, span), "doc_id long, spans array<struct<kind:string,start:long,stop:long>>")


def listed(spans: Column) -> Column:
    """Spans as text: ``kind:start:stop``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def digest(scanned: DataFrame, base: tuple[Rule, ...] = BASE) -> DataFrame:
    """``doc_id, n_<kind>..., base_sha256, spans``: counts of the base kinds, the hash of their spans, and all spans as text."""
    spans = F.col("spans")
    def of(*kinds: str) -> Column:
        return F.filter(spans, lambda s: s["kind"].isin(*kinds))

    counts = [F.size(of(r.kind)).cast("long").alias(f"n_{r.kind}") for r in base]
    own = of(*[r.kind for r in base])
    return scanned.select("doc_id", *counts, F.sha2(listed(own).cast("binary"), 256).alias("base_sha256"), listed(spans).alias("spans"))


def _blanked(batches: Iterator[pa.RecordBatch], rules: tuple[Rule, ...], text_col: str) -> Iterator[pa.RecordBatch]:
    scanner = Scanner(rules)
    for batch in batches:
        place = batch.schema.get_field_index(text_col)
        for low, high, data, off in slices(batch.column(place)):
            raw, ends = data.tobytes(), off.tolist()
            found = sorted((start, end, number) for _, number, start, end in scanner.find(raw, ends))
            joined: list[list[int]] = []
            for start, end, number in found:
                if joined and start < joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], end)
                else:
                    joined.append([start, end, number])
            by_text: dict[int, list[list[int]]] = {}
            for piece in joined:
                by_text.setdefault(bisect_right(ends, piece[0]) - 1, []).append(piece)
            own = batch.column(place).slice(low, high - low)
            out = own.to_pylist() if by_text else own
            for text, pieces in by_text.items():
                kept, at = [], ends[text]
                for start, end, number in pieces:
                    kept += [raw[at:start], b"<" + rules[number].kind.encode() + b">"]
                    at = end
                out[text] = b"".join([*kept, raw[at:ends[text + 1]]]).decode("utf-8", "replace")
            columns = [c.slice(low, high - low) for c in batch.columns]
            columns[place] = pa.array(out, pa.string()) if by_text else own
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)


def redacted(docs: DataFrame, text_col: str = "text", base: tuple[Rule, ...] = BASE, checked: tuple[Rule, ...] = CHECKED) -> DataFrame:
    """``docs`` with every found secret replaced by ``<kind>``; overlapping ones become one, named by the first.

    All rows and other columns stay; null stays null.
    """
    rules = (*base, *checked)
    return docs.mapInArrow(lambda it: _blanked(it, rules, text_col), docs.schema)
