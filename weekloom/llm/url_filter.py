"""URL filters: pattern rules indexed by their rarest literal token.

Method: every rule has literal tokens that any URL it fits must contain whole. It is filed under the
one that is rarest in the URLs to judge. A URL's tokens fetch the rules filed under them, and only those
run their regular expression.

Urls are judged where they are read: the index travels to the tasks, so there is no shuffle and no hot
host. It is sent in blocks of at most ``BLOCK_RULES`` rules, each a pass over the rows within the same
stage, so its size per block is bounded and no rule is left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKEN = r"[A-Za-z0-9]+"
#: Rules sent to the tasks at a time.
BLOCK_RULES = 100_000


@dataclass(frozen=True)
class Rule:
    """``pattern`` over host and path, e.g. ``example.org/en/1``: that host or a subdomain, path with that start.

    ``*`` stands for any characters. A pattern that starts with ``*`` is looked for anywhere. ``rank``
    separates classes of rules: a higher one wins whatever the lengths.
    """

    action: str
    pattern: str
    rank: int = 0


#: The rules of the contract, and this method's own for urls that none of them fits: link farms that name what they sell.
LISTED = (Rule("allow", "org/", 1), Rule("block", "example.org/es/", 1), Rule("block", "example.org/en/1", 1), Rule("allow", "com/fr/", 1), Rule("block", "com/de/", 1))
OWN = (Rule("block", "*cheap-pills."), Rule("block", "*cheap-meds."), Rule("block", "*online-casino."))


def regex_of(rule: Rule) -> str:
    """Over the subject ``host/path``, whole-string prefix match."""
    body = ".*".join(re.escape(x) for x in rule.pattern.lstrip("*").split("*"))
    return f".*{body}" if rule.pattern.startswith("*") else rf"(?:[^/]*\.)?{body}"


def tokens_of(rule: Rule) -> list[str]:
    """Literal tokens that a fitting URL has whole: those with a fixed neighbour on either side."""
    anywhere, text = rule.pattern.startswith("*"), rule.pattern.lstrip("*")
    found = []
    for m in re.finditer(TOKEN, text):
        open_start = m.start() == 0 and anywhere or text[m.start() - 1 : m.start()] == "*"
        if not open_start and text[m.end() : m.end() + 1] not in ("", "*"):
            found.append(m.group())
    return found


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; without ``://`` empty."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; without ``://`` empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def token_counts(subjects: DataFrame, wanted: list[str]) -> dict[str, int]:
    """In how many urls each wanted token occurs; the wanted ones are those of one block of rules."""
    if not wanted:
        return {}
    tokens = F.array_distinct(F.regexp_extract_all(F.col("subject"), F.lit(TOKEN), F.lit(0)))
    names = subjects.sparkSession.createDataFrame([(t,) for t in wanted], "token string")
    # the names are those of one block, so their number is bounded
    rows = subjects.select(F.explode(tokens).alias("token")).join(F.broadcast(names), "token").groupBy("token").count().collect()
    return {r.token: r["count"] for r in rows}


def indexed(rules: list[Rule], counts: dict[str, int]) -> dict[str, list[Rule]]:
    """Rules by their rarest token; those without a literal token are filed under the empty one, which every URL fetches."""
    index: dict[str, list[Rule]] = {}
    for rule in sorted(set(rules), key=lambda r: (r.pattern, r.action)):
        token = min(tokens_of(rule), key=lambda t: (counts.get(t, 0), t), default="")
        index.setdefault(token, []).append(rule)
    return index


def _judge(index: dict[str, list[Rule]]):
    """Best rule of each subject, compared with the best of the blocks before."""
    compiled = {token: [(r.rank, len(r.pattern), r.pattern, r.action, re.compile(regex_of(r), re.DOTALL)) for r in rules] for token, rules in index.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            columns = {n: batch.column(i) for i, n in enumerate(names)}
            out = []
            for subject, best in zip(columns["subject"].to_pylist(), columns["best"].to_pylist()):
                top = None if best is None else (best["rank"], best["length"], best["pattern"], best["action"])
                seen = {""} | set(re.findall(TOKEN, subject))
                for token in seen & compiled.keys():
                    for rank, length, pattern, action, regex in compiled[token]:
                        if (top is None or _beats((rank, length, pattern, action), top)) and regex.match(subject):
                            top = (rank, length, pattern, action)
                out.append(None if top is None else dict(zip(("rank", "length", "pattern", "action"), top)))
            columns["best"] = pa.array(out, batch.schema.field("best").type)
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], schema=batch.schema)
    return run


def _beats(a: tuple, b: tuple) -> bool:
    """Higher rank, then longer, then smaller pattern, then ``allow`` before ``block``."""
    return (-a[0], -a[1], a[2], a[3]) < (-b[0], -b[1], b[2], b[3])


def filter_urls(pages: DataFrame, rules: list[Rule] | tuple[Rule, ...] = LISTED + OWN, url_col: str = "url", keep: tuple[str, ...] = ("page_id",),
                default: str = "allow", block_rules: int = BLOCK_RULES) -> DataFrame:
    """(``keep`` columns, host, path, rule, rank, verdict), one row for each row of ``pages``.

    The longest fitting rule of the highest rank wins; verdict is its action, else ``default``.
    Defined results: a null url, or one without ``://``, has an empty host and path and gets the
    default unless a rule fits the empty string; repeated rows are judged alike; no rules at all give
    the default everywhere; other columns are not looked at.
    """
    best = T.StructType([T.StructField("rank", T.LongType()), T.StructField("length", T.LongType()), T.StructField("pattern", T.StringType()), T.StructField("action", T.StringType())])
    host, path = host_of(F.col(f"`{url_col}`")), path_of(F.col(f"`{url_col}`"))
    frame = pages.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], host.alias("host"), path.alias("path"),
                         F.concat(host, path).alias("subject"), F.lit(None).cast(best).alias("best"))
    subjects, ordered = frame.select("subject"), sorted(set(rules), key=lambda r: (r.pattern, r.action))
    for at in range(0, len(ordered), block_rules):
        block = ordered[at : at + block_rules]
        counts = token_counts(subjects, sorted({t for r in block for t in tokens_of(r)}))
        frame = frame.mapInArrow(_judge(indexed(block, counts)), frame.schema)
    return frame.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "host", "path", F.col("best.pattern").alias("rule"), F.col("best.rank").alias("rank"),
                        F.coalesce("best.action", F.lit(default)).alias("verdict"))
