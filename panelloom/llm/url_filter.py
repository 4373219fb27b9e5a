"""Operator 6: glob rules over URLs, all simulated at once as one bit-parallel Shift-And automaton."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The host and path rules as (verdict, host, path).
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
# Globs over `.host/path?query` that block a URL no rule fits.  `*` stays within a host label run or a
# path segment, `**` crosses everything, `?` is one character, `\` makes the next character literal.
BLOCKED = ("*.ads.**", "*.adserver.**", "*.doubleclick.net**", "*.tracker.**", "**/login**", "**/signin**",
           "**/cart**", "**/checkout**", "**/wp-admin/**", "**/cgi-bin/**", "**\\?*sessionid=**",
           "**\\?*replytocom=**", "**.exe", "**.zip", "**.apk", "*.casino.**", "*.porn**", "**/tag/*/page/**")
SEGMENT_ENDS = b"/?#"


class ShiftAnd:
    """The masks of all globs side by side in 64-bit words.

    A glob with m literals owns m + 1 neighbouring bits; bit j says "j literals are matched".  A star
    after literal j lets bit j stay, for the characters the star takes.  As no literal leads to a
    glob's first bit, a shift never leaks from one glob into the next.
    """

    def __init__(self, globs: Sequence[str]):
        cells: list[tuple[int | None, str]] = []
        self.first, self.last = [], []
        for glob in globs:
            self.first.append(len(cells))
            cells.append((None, ""))
            raw, i = glob.encode(), 0
            while i < len(raw):
                if raw[i:i + 1] == b"*":
                    width = 2 if raw[i:i + 2] == b"**" else 1
                    loops = "**" if width == 2 or cells[-1][1] == "**" else "*"
                    cells[-1] = (cells[-1][0], loops)
                    i += width
                else:
                    literal = -1 if raw[i:i + 1] == b"?" else raw[i]
                    if raw[i:i + 1] == b"\\" and i + 1 < len(raw):
                        i += 1
                        literal = raw[i]
                    cells.append((literal, ""))
                    i += 1
            self.last.append(len(cells) - 1)
        self.words = max(1, -(-len(cells) // 64))
        step = np.zeros((256, self.words * 64), bool)
        stay = np.zeros((256, self.words * 64), bool)
        inside = np.ones(256, bool)
        inside[list(SEGMENT_ENDS)] = False
        for j, (literal, loops) in enumerate(cells):
            if literal is not None:
                step[slice(None) if literal < 0 else literal, j] = True
            if loops:
                stay[:, j] = True if loops == "**" else inside
        start = np.zeros((1, self.words * 64), bool)
        start[0, self.first] = True
        self.step, self.stay, self.start = (self._packed(x) for x in (step, stay, start))

    @staticmethod
    def _packed(bits: np.ndarray) -> np.ndarray:
        return np.packbits(bits, axis=1, bitorder="little").view("<u8").astype(np.uint64)

    def matches(self, urls: Sequence[bytes]) -> np.ndarray:
        """One row per URL, one column per glob.  URLs advance together, longest first, so that
        those that have ended leave the work."""
        lengths = np.fromiter(map(len, urls), np.int64, len(urls))
        order = np.argsort(-lengths, kind="stable")
        data = np.frombuffer(b"".join(urls), np.uint8)
        starts = (np.cumsum(lengths) - lengths)[order]
        # How many URLs are longer than t, for every t.
        longer = len(urls) - np.cumsum(np.bincount(lengths, minlength=1))
        state = np.repeat(self.start, len(urls), axis=0)
        for t in range(int(lengths.max(initial=0))):
            n = int(longer[t])
            chars, now = data[starts[:n] + t], state[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:n] = (moved & self.step[chars]) | (now & self.stay[chars])
        out = np.empty((len(urls), len(self.last)), bool)
        for g, bit in enumerate(self.last):
            out[order, g] = (state[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1)
        return out


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", rules: Sequence[tuple[str, str, str]] = RULES,
          blocked: Sequence[str] = BLOCKED) -> DataFrame:
    """One row per page: key, host, path, rule, verdict, canonical_url and the globs that matched.

    The longest rule (host and path together; of equals the first given) that fits decides; where none
    fits, a URL is blocked if one of ``blocked`` matches it, else allowed.  NULL and URLs without
    ``://`` have an empty host and path and are allowed.  Repeated pages give repeated rows; columns of
    the input other than the two named are not looked at.
    """
    globs = [f"*.{host}{path}**" for _, host, path in rules] + list(blocked)
    by_length = sorted(range(len(rules)), key=lambda i: (-len(rules[i][1] + rules[i][2]), i))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ShiftAnd(globs)
        names = np.array(list(globs), object)
        for batch in batches:
            hosts, paths, wholes = batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()
            found = automaton.matches([x.encode() for x in wholes])
            rule = np.full(len(hosts), None, object)
            verdict = np.where(found[:, len(rules):].any(axis=1), "block", "allow").astype(object)
            for i in reversed(by_length):
                rule[found[:, i]] = rules[i][1] + rules[i][2]
                verdict[found[:, i]] = rules[i][0]
            globbed = [list(names[len(rules):][row]) for row in found[:, len(rules):]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(rule, pa.string()),
                 pa.array(verdict, pa.string()), pa.array(wholes, pa.string()), pa.array(globbed, pa.list_(pa.string()))],
                names=[key, "host", "path", "rule", "verdict", "canonical_url", "globs"])

    address = F.coalesce(F.when(F.instr(url, "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")), F.lit(""))
    host_raw = F.regexp_extract("_address", r"(?s)^([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    parts = (pages.select(F.col(key).alias("_key"), address.alias("_address"))
             .select("_key", F.translate(host_raw, upper, lower).alias("_host"),
                     F.regexp_extract("_address", r"(?s)^[^/?#]*([^?#]*)", 1).alias("_path"),
                     F.regexp_extract("_address", r"(?s)^[^?#]*(\?[^#]*)", 1).alias("_query")))
    whole = F.concat(F.lit("."), "_host", "_path", "_query")
    kind = dict(pages.dtypes)[key]
    return (parts.select("_key", "_host", "_path", whole.alias("_whole"))
            .mapInArrow(run, f"`{key}` {kind}, host string, path string, rule string, verdict string, "
                             "canonical_url string, globs array<string>"))
