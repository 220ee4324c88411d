"""URL rules as one bit-parallel wildcard automaton.

Every rule is a glob over the canonical URL ``.host/path``.  All globs lie one
after another in a bit vector of as many 64-bit words as they need; a step of
the Shift-And automaton moves every glob by one byte of the URL:

    state = (state << 1) & consume[byte]  |  state & stay[byte]

``consume`` marks the positions that take a byte, ``stay`` the positions a
wildcard loops on.  A whole Arrow batch of URLs steps together in numpy.

Glob syntax: ``*`` any bytes, ``+`` any bytes but ``/`` (a part of the host),
``?`` one byte, everything else itself.

Edge cases: a null URL or one without ``://`` has an empty host and path and
fits no host rule; repeated URLs are judged each; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.llm.spans import U64, text_bytes, tidy

# Fixed rules of the registered query: (verdict, host, path).
RULES: tuple[tuple[str, str, str], ...] = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
DEFAULT_VERDICT = "allow"   # of the automaton when no rule fits
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_glob(host: str, path: str) -> str:
    """Glob of a rule for a host with all subdomains and a path prefix."""
    return f"+.{host}{path}*"


class ShiftAnd:
    """All globs in one automaton; ``match`` tells which globs fit which URL."""

    def __init__(self, globs: Sequence[str]) -> None:
        cells: list[tuple[str, bytes | None]] = []  # a position's loop and the byte it takes
        self.last: list[int] = []
        begin: list[int] = []
        for glob in globs:
            begin.append(len(cells))
            cells.append(("", b""))                # start position: taken by no byte
            for b in glob.encode():
                if b in b"*+":
                    cells[-1] = (chr(b), cells[-1][1])
                else:
                    cells.append(("", None if b == ord("?") else bytes([b])))
            self.last.append(len(cells) - 1)
        self.words = -(-len(cells) // 64) or 1
        consume, stay = np.zeros((256, self.words * 64), bool), np.zeros((256, self.words * 64), bool)
        for i, (loop, byte) in enumerate(cells):
            if byte is None:
                consume[:, i] = True
            elif byte:
                consume[byte[0], i] = True
            if loop:
                stay[:, i] = True
                if loop == "+":
                    stay[ord("/"), i] = False
        start = np.zeros((1, self.words * 64), bool)
        start[0, begin] = True
        self.consume, self.stay, self.start = (self._pack(x) for x in (consume, stay, start))

    def _pack(self, bits: np.ndarray) -> np.ndarray:
        return np.packbits(bits, axis=1, bitorder="little").view(U64)

    def match(self, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Boolean matrix (URL, glob)."""
        length = np.diff(off)
        order = np.argsort(-length, kind="stable")
        length, at = length[order], off[:-1][order]
        state = np.repeat(self.start, len(order), axis=0)
        live = len(order)
        for step in range(int(length[0]) if live else 0):
            live = int(np.searchsorted(-length[:live], -step, "left"))  # URLs longer than step
            byte = raw[at[:live] + step]
            now = state[:live]
            moved = now << U64(1)
            moved[:, 1:] |= now[:, :-1] >> U64(63)
            state[:live] = (moved & self.consume[byte]) | (now & self.stay[byte])
        out = np.empty((len(order), len(self.last)), bool)
        for g, i in enumerate(self.last):
            out[order, g] = (state[:, i // 64] >> U64(i % 64)) & U64(1)
        return out


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
          globs: Sequence[tuple[str, str]] = (), default: str = DEFAULT_VERDICT) -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    The longest fitting rule wins (equal lengths: the first listed).  Where no
    rule fits, the first fitting glob of ``globs`` (verdict, glob over
    ``.host/path``) decides, and then ``default``; ``rule`` is null then.
    """
    named = [(v, h + p, host_glob(h, p)) for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2]))]
    named += [(v, None, g) for v, g in globs]
    automaton = ShiftAnd([g for _, _, g in named])
    schema = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()),
                        ("rule", pa.string()), ("verdict", pa.string())])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules_ = pa.array([r for _, r, _ in named] + [None], pa.string())
        verdicts = pa.array([v for v, _, _ in named] + [default], pa.string())
        for b in batches:
            for lo in range(0, b.num_rows, 4096):
                part = b.slice(lo, 4096)
                fits = automaton.match(*text_bytes(part.column(3)))
                first = np.where(fits.any(axis=1), fits.argmax(axis=1), len(named)) if named else \
                    np.zeros(part.num_rows, np.int64)
                pick = pa.array(first)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), part.column(1).cast(pa.string()),
                     part.column(2).cast(pa.string()), rules_.take(pick), verdicts.take(pick)], schema=schema)

    url = F.coalesce(F.col("url"), F.lit(""))
    parts = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    canonical = parts.withColumn("canonical", F.concat(F.lit("."), "host", "path"))
    return canonical.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")


def op10_url_filter(spark: SparkSession, pages: DataFrame) -> DataFrame:
    return judge(pages)


ORACLE = r"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), h AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw_host FROM u
), p AS (
  SELECT page_id,
         translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path
  FROM h
), rules(verdict, rhost, rpath) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), fit AS (
  SELECT p.page_id, rhost || rpath AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(rhost || rpath) DESC) AS k
  FROM p JOIN rules r ON (p.host = rhost OR p.host LIKE '%.' || rhost) AND starts_with(p.path, rpath)
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM p LEFT JOIN fit f ON f.page_id = p.page_id AND f.k = 1
"""
