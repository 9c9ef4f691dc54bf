"""URL filters: pattern rules indexed by their rarest literal token; a URL's tokens fetch the rules that are run on it.

A pattern is literal text with four marks: `||` at the start (a host's label begins here), `|` at the start or end (the
text begins or ends here), `*` (anything) and `^` (a separator or either end). Separators are ASCII characters other than
letters, digits, `_` and `%`; between them lie tokens. A token of a pattern that a URL must hold as a whole, as separators,
`^` or anchors enclose it, is safe. Every rule is filed under the one of its safe tokens that the fewest URLs of the table
hold, counted over all of them, so a URL fetches few rules, and only those run their regular expressions. Rules without a
safe token are run on every URL.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.llm.common import prepared

SEPARATOR = r"[\x00-\x24\x26-\x2F\x3A-\x40\x5B-\x5E\x60\x7B-\x7F]"
_TOKENS = re.compile(SEPARATOR.replace("[", "[^", 1) + "+")
_UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
MOST_RULES = 1_000_000  # every worker holds the rules


@dataclass(frozen=True)
class Rule:
    """A pattern over host and path, or over the host alone. Of the rules that fit, the lowest tier decides, in it the
    longest name, then `block`, then the smallest name."""

    verdict: str
    pattern: str
    name: str = ""
    tier: int = 1
    host_only: bool = False


def site(verdict: str, host: str, path: str = "/") -> Rule:
    """Host and subdomains, for paths that start with `path`."""
    return Rule(verdict, f"||{host}{path}", host + path, 0)


def _pieces(pattern: str) -> list[str]:
    """Regular expressions for what stands between the `*`, to be found one after the other."""
    start, end = "", ""
    if pattern.startswith("||"):
        start, pattern = r"^(?:[^/]*?\.)??", pattern[2:]
    elif pattern.startswith("|"):
        start, pattern = "^", pattern[1:]
    if pattern.endswith("|"):
        end, pattern = r"\Z", pattern[:-1]
    pieces = ["".join(f"(?:^|{SEPARATOR}|$)" if c == "^" else re.escape(c) for c in piece) for piece in pattern.split("*")]
    pieces[0] = start + pieces[0]
    pieces[-1] += end
    return pieces


def _regex(pattern: str) -> str:
    """The whole pattern as one expression, for engines that need no backtracking."""
    return "(?s)" + ".*".join(_pieces(pattern))


def fits(pieces: Sequence[re.Pattern], text: str) -> bool:
    """Are the pieces there in this order? The first place of each leaves the most for the next, so there is no way back."""
    at = 0
    for piece in pieces:
        found = piece.search(text, at)
        if not found:
            return False
        at = found.end()
    return True


def safe_tokens(pattern: str) -> list[str]:
    """Tokens that every fitting URL holds as a whole, with A-Z lower-cased."""
    body = pattern.lstrip("|")
    body = body.removesuffix("|")
    out = []
    for m in re.finditer(r"[^*]+", body):
        for t in _TOKENS.finditer(m[0]):
            left = t.start() > 0 or (m.start() == 0 and pattern.startswith("|"))
            right = t.end() < len(m[0]) or (m.end() == len(body) and pattern.endswith("|"))
            if left and right:
                out.append(t[0].translate(_UPPER))
    return out


def parts(url: str | None) -> tuple[str, str]:
    """Host with A-Z lower-cased, and path; both empty without `://`."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(_UPPER), re.match(r"[^?#]*", rest[len(host):])[0]


def _tokens(url: Column) -> Column:
    """Distinct tokens of host and path, as the driver's counts see them."""
    rest = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.array_distinct(F.split(F.translate(rest, upper, lower), SEPARATOR))


def token_counts(pages: DataFrame, rules: Sequence[Rule], url: str = "url") -> dict[str, int]:
    """In how many URLs each safe token of the rules occurs: one number per token of a rule."""
    wanted = sorted({t for r in rules for t in safe_tokens(r.pattern)})
    if not wanted:
        return {}
    spark = pages.sparkSession
    tokens = spark.createDataFrame([(t,) for t in wanted], "token string")  # bounded by the rules
    found = pages.select(F.explode(_tokens(F.col(url))).alias("token")).join(F.broadcast(tokens), "token")
    return {t: 0 for t in wanted} | {r.token: r.n for r in found.groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()}


@dataclass
class Index:
    """Rules filed under their rarest safe token."""

    by_token: dict[str, list[Rule]]
    always: list[Rule]

    @classmethod
    def of(cls, rules: Sequence[Rule], counts: dict[str, int]) -> Index:
        index = cls({}, [])
        for rule in rules:
            safe = safe_tokens(rule.pattern)
            if safe:
                index.by_token.setdefault(min(safe, key=lambda t: (counts.get(t, 0), t)), []).append(rule)
            else:
                index.always.append(rule)
        return index

    def candidates(self, address: str) -> list[Rule]:
        out = list(self.always)
        for token in {t.translate(_UPPER) for t in _TOKENS.findall(address)} & self.by_token.keys():
            out += self.by_token[token]
        return out

    def deciding(self, host: str, path: str, compiled: dict[str, list[re.Pattern]]) -> tuple[Rule | None, int]:
        """The rule that decides, and how many regular expressions were run."""
        best, tried = None, self.candidates(host + path)
        for rule in tried:
            if rule.pattern not in compiled:
                compiled[rule.pattern] = [re.compile(x, re.DOTALL) for x in _pieces(rule.pattern)]
            if fits(compiled[rule.pattern], host if rule.host_only else host + path):
                rank = (rule.tier, -len(rule.name), rule.verdict != "block", rule.name)
                if best is None or rank < best[0]:
                    best = (rank, rule)
        return (best[1] if best else None), len(tried)


def judged(pages: DataFrame, rules: Sequence[Rule], keep: Sequence[str | Column] = ("page_id",), url: str = "url",
           default: str = "allow") -> DataFrame:
    """`keep` columns with (host, path, rule, verdict, pattern, n_tried), one row per input row.

    `rule` is the name of the deciding rule of tier 0, `pattern` the pattern of the deciding rule of another tier; both are
    NULL where no rule fits, and the verdict is then `default`. A NULL or empty URL, and one without `://`, has an empty
    host and path, and only rules that fit empty text decide on it. Very long URLs are taken whole. Repeated rows are
    judged each. An empty table gives no rows. Other columns of the table play no part, whatever their names.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules, as every worker holds them")
    prepared(pages.sparkSession)
    index = Index.of(rules, token_counts(pages, rules, url))

    @F.pandas_udf("host string, path string, rule string, verdict string, pattern string, n_tried int")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        compiled: dict[str, list[re.Pattern]] = {}
        for batch in batches:
            out = []
            for address in batch:
                host, path = parts(address)
                rule, tried = index.deciding(host, path, compiled)
                out.append((host, path, rule.name if rule and not rule.tier else None, rule.verdict if rule else default,
                            rule.pattern if rule and rule.tier else None, tried))
            yield pd.DataFrame(out, columns=["host", "path", "rule", "verdict", "pattern", "n_tried"])

    return pages.select(*keep, judge(F.col(url).cast("string")).alias("__j")).select(
        *[F.col(k) if isinstance(k, str) else F.col(pages.select(k).columns[0]) for k in keep], "__j.*")


#: The rules on hosts and paths.
SITES = [site("allow", "org"), site("block", "example.org", "/es/"), site("block", "example.org", "/en/1"),
         site("allow", "com", "/fr/"), site("block", "com", "/de/")]

#: Words that a host carries as a whole label or part of one where a site sells bets, pills, adult content or clicks.
UNWANTED = ["adserver", "adult", "bet", "bets", "betting", "bingo", "casino", "casinos", "escort", "escorts", "gambling",
            "jackpot", "linkfarm", "lottery", "pills", "poker", "porn", "porno", "roulette", "sex", "slots", "spam", "viagra",
            "warez", "webcams", "xxx"]
DEFAULTS = [Rule("block", f"^{word}^", word, host_only=True) for word in UNWANTED] + [
    Rule("block", "||ads^", "ads", host_only=True),
    Rule("block", "^tracker^", "tracker", host_only=True),
    Rule("block", "||tracking.", "tracking", host_only=True),
    Rule("block", "/phpmyadmin/", "phpmyadmin"),
    Rule("block", "^wp-login.php", "wp-login"),
    Rule("block", "*/cgi-bin/*redirect^", "redirect"),
    Rule("allow", "||gov^", "gov", host_only=True),
]


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def oracle(rules: Sequence[Rule] = (*SITES, *DEFAULTS)) -> str:
    """The judgement with every rule run on every URL, as SQL."""
    ranked = sorted(rules, key=lambda r: (r.tier, -len(r.name), r.verdict != "block", r.name))
    fits = {r: f"regexp_matches({'host' if r.host_only else 'host || path'}, {_quoted(_regex(r.pattern))})" for r in ranked}
    verdict = "\n    ".join(f"when {fits[r]} then {_quoted(r.verdict)}" for r in ranked)
    rule = "\n    ".join(f"when {fits[r]} then {_quoted(r.name)}" for r in ranked if not r.tier)
    pattern = "\n    ".join(f"when {fits[r]} then {_quoted(r.pattern) if r.tier else 'null'}" for r in ranked)
    return rf"""
with addresses as (
  select page_id,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') as path
  from pages)
select page_id, host, path,
  case {rule} end as rule,
  case {verdict} else 'allow' end as verdict,
  case {pattern} end as pattern
from addresses
"""
