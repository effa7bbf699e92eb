"""Script literals of a page as JSON: one tokenizer for every chart library.

A page's scripts are cut into tokens by one pattern and written again as JSON text: comments go, keys and assigned
names become ``"name":``, other quotes become double ones, dates become milliseconds, ``undefined`` and holes become
null, commas before a closing bracket go. What stands behind a name is then read by the JSON parser itself, which stops at the
end of the value, so brackets, strings and nulls inside of it need no pattern.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"-?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?"
_NUMBERS = rf"{_NUMBER}(?![\w.])(?:\s*,\s*{_NUMBER}(?![\w.]|\s*:))*+"
_NAME = r"[A-Za-z_$][\w$]*"
#: Alternatives in order; long runs of numbers and of number pairs are single tokens.
TOKEN = "(?s)" + "|".join([
    r'"(?:[^"\\\n]|\\.)*+"', r"'(?:[^'\\\n]|\\.)*+'", r"`(?:[^`\\]|\\.)*+`",
    r"//[^\n]*+", r"/\*.*?\*/",
    rf"\[\s*{_NUMBERS}\s*\](?:\s*,\s*\[\s*{_NUMBERS}\s*\])*+",
    r"(?:new\s+Date|Date\.UTC)\s*\(\s*(?:\d+(?:\s*,\s*\d+)*+|\"[^\"\n]*+\"|'[^'\n]*+')?\s*\)",
    rf"(?:{_NAME}\s*\.\s*)*+{_NAME}\s*(?::(?!:)|=(?![=>]))",
    r"\bnew\s+", rf"(?:{_NAME}\s*\.\s*)*+{_NAME}\s*\(", r"\d+\s*:", _NUMBERS, rf"(?:{_NAME}\s*\.\s*)*+{_NAME}",
    r",\s*+[\]}]", r"[\[,](?:\s*+,)++", r"\s++", "."])

_SCRIPT = r"(?si)<script[^>]*>(.*?)</script>"
_PUSHED = r'(?s)__next_f\.push\(\s*\[\s*1\s*,\s*("(?:[^"\\]|\\.)*+")\s*\]\s*\)'


def _quoted(inner: Column) -> Column:
    """The text between other quotes as a JSON string."""
    plain = F.regexp_replace(F.regexp_replace(inner, r"\\(['`])", "$1"), r'(?<!\\)"', r'\\"')
    return F.concat(F.lit('"'), F.regexp_replace(plain, r"\n", r"\\n"), F.lit('"'))


def _date(token: Column) -> Column:
    """Milliseconds of ``new Date(...)`` or ``Date.UTC(...)``; a text stays a text; months count from 0."""
    parts = F.transform(F.regexp_extract_all(token, F.lit(r"\d+"), F.lit(0)), lambda p: p.try_cast("int"))
    day = F.add_months(F.make_date(F.get(parts, F.lit(0)), F.lit(1), F.lit(1)), F.coalesce(F.get(parts, F.lit(1)), F.lit(0)))
    ms = F.unix_date(F.date_add(day, F.coalesce(F.get(parts, F.lit(2)), F.lit(1)) - 1)).cast("bigint") * 86_400_000
    text = F.regexp_extract(token, "[\"']([^\"']*)[\"']", 1)
    one = F.regexp_extract(token, r"\(\s*(\d+)\s*\)", 1)
    return (F.when(text != "", F.concat(F.lit('"'), text, F.lit('"'))).when(one != "", one)
            .when((F.size(parts) > 1) & (F.get(parts, F.lit(0)).between(1, 9999)) & (F.coalesce(F.get(parts, F.lit(1)), F.lit(0)) < 1200), ms.cast("string")).otherwise(F.lit("null")))


def _as_json(token: Column) -> Column:
    first, last = F.substring(token, 1, 1), F.substring(token, -1, 1)
    name = F.regexp_extract(token, rf"({_NAME}|\d+)\s*[:=]$", 1)
    return (F.when(first == '"', F.when(F.length(token) > 1, F.regexp_replace(token, r"\\'", "'")).otherwise(F.lit("")))
            .when(first.isin("'", "`"), F.when(F.length(token) > 1, _quoted(F.substring(token, F.lit(2), F.length(token) - 2))).otherwise(F.lit("")))
            .when(first.rlike(r"\s") | token.startswith("//") | token.startswith("/*"), F.lit(""))
            .when(token.rlike(r"^(?:new\s+Date|Date\.UTC)\s*\("), _date(token))
            .when(token.rlike(r"^new\s+$"), F.lit(""))
            .when(last.isin(":", "=") & (name != ""), F.concat(F.lit('"'), name, F.lit('":')))
            .when((first == ",") & last.isin("]", "}"), last)
            .when(token.rlike(r"^[\[,]\s*,"), F.concat(first, F.regexp_replace(F.regexp_replace(F.substring(token, F.lit(2), F.length(token)), r"\s", ""), ",", "null,")))
            .when((last == "(") | first.rlike(r"[-\d]"), token)
            .when(token.isin("null", "true", "false"), token)
            .when(first.rlike(r"[A-Za-z_$]"), F.lit("null"))
            .otherwise(token))


def literal_json(text: Column) -> Column:
    """Script text with its literals as JSON; the rest of the script stays between them as it may."""
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), _as_json), "")


def script_text(html: Column) -> Column:
    """Scripts of a page, texts that a framework pushes in pieces, and what stands outside of scripts without its tags."""
    bodies = F.regexp_extract_all(html, F.lit(_SCRIPT), F.lit(1))
    pushed = F.transform(F.regexp_extract_all(html, F.lit(_PUSHED), F.lit(1)), lambda t: F.try_variant_get(F.try_parse_json(t), "$", "string"))
    outside = F.regexp_replace(F.regexp_replace(html, _SCRIPT, " "), r"<[^>]*>", " ")
    return F.concat_ws("\n", F.array_join(bodies, "\n"), F.array_join(F.filter(pushed, lambda p: p.isNotNull()), ""), outside)


def page_literals(html: Column) -> Column:
    """``literal_json`` of a page's scripts; null for pages without any name that charts use."""
    hint = html.rlike(r"(?:data|series|seriesData|labels|categories|\bx)\\?[\"']?\s*[:=]|Dygraph")
    return F.when(hint, literal_json(script_text(html)))


def behind(json_text: Column, before: str, value: str = r"[\[{]") -> Column:
    """Texts that start with the values behind every match of ``before``; each ends at the next one or at the end of the page."""
    parts = F.split(json_text, rf"{before}(?={value})", -1)
    return F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))


def first_behind(json_text: Column, before: str, value: str = r"\[") -> Column:
    """The text from the first value behind ``before`` on, or null."""
    return F.get(F.split(json_text, rf"{before}(?={value})", 2), F.lit(1))
