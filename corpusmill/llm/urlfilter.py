"""URL filters by a bit-parallel wildcard automaton.

All glob rules are packed side by side into 64-bit words of a Shift-And
automaton; each character of a canonical URL is one shift, mask and merge
over all words, for all rules and all URLs of a batch at once.  A ``*``
loops on its state (over any character) and ``^`` loops over any character
but ``/``, so that it stays inside the host.

The canonical URL is ``.host`` (lower-cased) followed by the path; the rule
(host, path) is the glob ``^.host`` + path + ``*``: the leading ``^.`` lets
it fit the host and every subdomain.  Of the list rules that fit, the longest wins;
a URL that none fits is judged by the extra globs, and allowed if none of
them fits.

Defined results: a null URL or one without ``://`` has an empty host and
path, fits no list rule (so the extra globs judge an empty canonical URL)
and is allowed; repeated rows are judged one by one; other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import LOWER, UPPER, add_columns

# The contract's rules.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
# Globs over the canonical URL that block what no rule of the list fits.
BLOCK_GLOBS = ["^/*.zip", "^/*.exe", "^/login*", "^/*/login*", "^/cart/*", "*/wp-admin*", "^casino^", "^casino^/*"]
LOWER_MAP = str.maketrans(UPPER, LOWER)
PARTS = re.compile(r"(?s)://([^/?#]*)([^?#]*)")


@dataclass(frozen=True)
class Rule:
    verdict: str
    glob: str
    name: str | None = None  # of a list rule


def list_rule(verdict: str, host: str, path: str) -> Rule:
    return Rule(verdict, f"^.{host}{path}*", f"{host}{path}")


def split_url(url: str | None) -> tuple[str, str]:
    m = PARTS.search(url) if url else None
    return (m[1].translate(LOWER_MAP), m[2]) if m else ("", "")


class ShiftAnd:
    """Simulates all globs over many strings at once.

    A glob is a sequence of states, one for each literal byte, after a start
    state.  A loop symbol lets the state before it stay on any byte
    (``*``) or on any but ``/`` (``^``).  A glob must match the whole string.
    """

    def __init__(self, globs: list[str]):
        starts, ends, loops, loops_host, literal = [], [], [], [], {}
        bit = 0
        for g in globs:
            starts.append(bit)
            for ch in g.encode():
                if ch == ord("*"):
                    loops.append(bit)
                elif ch == ord("^"):
                    loops_host.append(bit)
                else:
                    bit += 1
                    literal.setdefault(ch, []).append(bit)
            ends.append(bit)
            bit += 1
        self.words = max(1, (bit + 63) // 64)
        self.start, self.ends = self.mask(starts), ends
        any_loop, host_loop = self.mask(loops), self.mask(loops_host)
        # masks by byte: states entered by it, and states that stay on it
        self.enter = np.stack([self.mask(literal.get(c, [])) for c in range(256)])
        self.stay = np.stack([any_loop | (host_loop if c != ord("/") else np.uint64(0)) for c in range(256)])

    def mask(self, bits: list[int]) -> np.ndarray:
        out = np.zeros(self.words, np.uint64)
        for b in bits:
            out[b // 64] |= np.uint64(1) << np.uint64(b % 64)
        return out

    def matches(self, strings: list[bytes]) -> np.ndarray:
        """Boolean matrix: string by glob."""
        order = np.argsort([-len(s) for s in strings], kind="stable")
        lens = np.array([len(strings[i]) for i in order], np.int64)
        state = np.tile(self.start, (len(strings), 1))
        data = np.frombuffer(b"".join(strings[i] for i in order), np.uint8)
        at = np.concatenate(([0], np.cumsum(lens)[:-1])) if len(lens) else np.zeros(0, np.int64)
        one, top = np.uint64(1), np.uint64(63)
        for k in range(int(lens[0]) if len(lens) else 0):
            live = int(np.searchsorted(-lens, -k, "left"))  # strings longer than k
            c = data[at[:live] + k]
            s = state[:live]
            moved = s << one
            moved[:, 1:] |= s[:, :-1] >> top
            state[:live] = (moved & self.enter[c]) | (s & self.stay[c])
        out = np.empty((len(strings), len(self.ends)), bool)
        for j, e in enumerate(self.ends):
            out[order, j] = (state[:, e // 64] >> np.uint64(e % 64)) & one
        return out


def judge(urls: list[str | None], automaton: ShiftAnd, rules: list[Rule], default: str):
    parts = [split_url(u) for u in urls]
    fits = automaton.matches([b"" if not (h or p) else f".{h}{p}".encode() for h, p in parts])
    ranked = sorted((i for i, r in enumerate(rules) if r.name is not None),
                    key=lambda i: -len(rules[i].name))
    extra = [i for i, r in enumerate(rules) if r.name is None]
    names, verdicts = [], []
    for row in fits:
        best = next((i for i in ranked if row[i]), None)
        names.append(None if best is None else rules[best].name)
        if best is None:
            best = next((i for i in extra if row[i]), None)
        verdicts.append(default if best is None else rules[best].verdict)
    return [p[0] for p in parts], [p[1] for p in parts], names, verdicts


def filter_urls(pages: DataFrame, url_col: str = "url", rules: list[tuple[str, str, str]] = RULES,
                block_globs: list[str] = BLOCK_GLOBS, default: str = "allow",
                keep: list[str] | None = None) -> DataFrame:
    """``pages`` with host, path, rule and verdict of each URL."""
    compiled = [list_rule(*r) for r in rules] + [Rule("block", g) for g in block_globs]

    def make():
        automaton = ShiftAnd([r.glob for r in compiled])
        return lambda urls: list(judge(urls, automaton, compiled, default))

    return add_columns(pages, [url_col], "host string, path string, rule string, verdict string", make, keep)


def report(pages: DataFrame) -> DataFrame:
    return filter_urls(pages, keep=["page_id"]).select("page_id", "host", "path", "rule", "verdict")


ORACLE_SQL = f"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)://([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
rules(verdict, rhost, rpath) AS (VALUES {", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)}),
fits AS (
  SELECT page_id, host, path, rhost || rpath AS rule, rules.verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC) AS k
  FROM parts LEFT JOIN rules ON ('.' || host) LIKE ('%.' || rhost) AND starts_with(path, rpath))
SELECT page_id, host, path, rule,
       CASE WHEN rule IS NOT NULL THEN verdict
            WHEN (path LIKE '/%.zip' OR path LIKE '/%.exe' OR starts_with(path, '/login') OR path LIKE '/%/login%'
                  OR starts_with(path, '/cart/') OR path LIKE '%/wp-admin%' OR host LIKE '%casino%') THEN 'block'
            ELSE 'allow' END AS verdict
FROM fits WHERE k = 1
"""
