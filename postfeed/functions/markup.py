"""Formatting rules for posting texts, as column expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postfeed.functions.keys import _col
from postfeed.functions.text import strip

# The tags a posting may hold.
ALLOWED_TAGS = ["b", "strong", "u", "i", "br", "p", "ul", "li", "em"]

# The labels that stand at the end of a posting.
LABELS = ["[#J-REMOTE]", "[#J-INTERNAL]", "[#J-MCITY]", "[#J-ENTERPRISE]", "[#J-ONE]", "[#J-MIN]"]

# The head of a posting. {company}, {brand}, {summary} and {places} are filled in.
INTRO = "<p><strong>Questa posizione è in {company}</strong><p><br>"
SUMMARY_HEAD = "<p><strong>Riassunto dell'opportunità da parte della <i>{brand}</i>:</strong>"
SUMMARY_END = "</p><br><br>"
CLOSING = "<br><p><em>Il processo di selezione sarà interamente gestito da {company}.</em></p>"
PLACES = "<br><br><p><em>Questa opportunità è disponibile su {places}</em></p>"

# The sample summary the length rule refers to is about this long.
SUMMARY_MAX_CHARS = 450

_WS = r"[ \t\r\n\f]"
_ATTRS = r"(?:[ \t\r\n\f/][^<>]*)?"
_ANY_TAG = r"<[a-zA-Z/!?][^<>]*>"
_ALLOWED = "|".join(ALLOWED_TAGS)
_LABEL = r"\[#J-(?:REMOTE|INTERNAL|MCITY|ENTERPRISE|ONE|MIN)\]"
# An address does not end in a dash, so one inside a comment leaves the comment's end alone.
_URL = r"(?i)https?://[^ \t\r\n\f<>\"]*[^ \t\r\n\f<>\"-]"
_HIDDEN = rf"(?is)<!--.*?-->|<script{_ATTRS}>.*?</script{_WS}*+>|<style{_ATTRS}>.*?</style{_WS}*+>"
# What opens a hidden part and what closes it. Behind the last closing mark an opening one hides nothing; there
# it gets a noncharacter, so that the pattern above does not look for its end again and again.
_HIDDEN_ENDS = [("!--", "-->"), ("script", rf"</script{_WS}*+>"), ("style", rf"</style{_WS}*+>")]
_UNCLOSED = "<\uFDD0"
_ANCHOR = rf"(?i)</?a(?:{_WS}[^<>]*)?>"
# The parts a head can end with, the last part first: what marks the part and what ends it.
_PLACES_MARK = "Questa opportunità è disponibile su "
_CLOSING_MARK = "Il processo di selezione sarà interamente gestito da "
_COMPANY_MARK = "Questa posizione è in "
_SUMMARY_MARK = "Riassunto dell'opportunità da parte della <i>"
_UP_TO_SUMMARY = rf"(?s)^.*?{_SUMMARY_MARK}[^<]*+</i>:</strong>"
_END = "</em></p>"
# One line break, and a run of them. Possessive, so that a run of any length needs no stack and no second look.
_BR = rf"<br{_WS}*+/?+>"
_BR_RUN = rf"{_BR}(?:{_WS}*+{_BR})*+"
_P_OPEN = rf"<p(?:{_WS}[^<>]*)?>"


def _drop(value: Column, pattern: str) -> Column:
    return F.regexp_replace(value, pattern, "")


def allow_tags(html: Column | str) -> Column:
    """Only the allowed tags, without attributes; other tags go, their text stays."""
    allowed = _drop(_col(html), rf"(?i)<(?!/?(?:{_ALLOWED})[ \t\r\n\f/>])[a-zA-Z/!?][^<>]*>")
    return F.regexp_replace(allowed, rf"(?i)<(/?)({_ALLOWED})[ \t\r\n\f/][^<>]*>", "<$1$2>")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _mark_unclosed(html: Column, opener: str, closer: str) -> Column:
    def split(text: Column) -> Column:
        def mark(closed: Column) -> Column:
            rest = F.substr(text, F.length(closed) + 1)
            return F.concat(closed, F.regexp_replace(rest, f"(?i)<({opener})", f"{_UNCLOSED}$1"))

        return F.when(text.rlike(f"(?i)<{opener}"), _let(F.regexp_extract(text, f"(?is)^.*{closer}", 0), mark)).otherwise(text)

    return _let(html, split)


def drop_hidden(html: Column | str) -> Column:
    """No comments, scripts and styles. The time grows with the length of the text, whatever is left open."""
    html = _col(html)
    for opener, closer in _HIDDEN_ENDS:
        html = _mark_unclosed(html, opener, closer)
    return F.replace(_drop(html, _HIDDEN), F.lit(_UNCLOSED), F.lit("<"))


def map_tags(html: Column | str) -> Column:
    """Unsupported tags become supported ones; scripts, styles and comments go with their content."""
    return allow_tags(_blocks(_ordered_lists(_headings(drop_hidden(html)))))


def _headings(html: Column) -> Column:
    opened = F.regexp_replace(html, rf"(?i)<h[1-6]{_ATTRS}>", "<p><strong>")
    return F.regexp_replace(opened, rf"(?i)</h[1-6]{_WS}*>", "</strong></p>")


def _ordered_lists(html: Column) -> Column:
    return F.regexp_replace(html, rf"(?i)<(/?)ol{_ATTRS}>", "<$1ul>")


def _blocks(html: Column) -> Column:
    return F.regexp_replace(html, rf"(?i)<(/?)(?:div|section|article){_ATTRS}>", "<$1p>")


def _addresses(html: Column) -> Column:
    return _drop(html, _URL)


# Tags as ``allow_tags`` leaves them, and what stands between them.
_TAG_TOKENS = rf"(?i)</?(?:{_ALLOWED})>|[^<]+|<"


def balance_tags(html: Column | str) -> Column:
    """Every tag closed in the order of nesting, for a text of allowed tags without attributes.

    A paragraph ends an open one, an item ends an open item of its list and begins a list if there is none. A
    closing tag closes what is open inside; one that closes nothing goes. The stack of open tags goes along the
    tokens of the text, innermost first. Time grows with tokens times length, both bounded by the column's width.
    """
    stack_at = lambda stack, tag: F.locate(tag, stack)

    def step(acc: Column, token: Column) -> Column:
        stack, out = acc["stack"], acc["out"]
        tag = F.lower(F.replace(token, F.lit("/"), F.lit("")))
        is_tag = token.rlike(rf"(?i)^</?(?:{_ALLOWED})>$") & (tag != "<br>")
        closing = is_tag & token.startswith("</")
        # Innermost open tags that go before this one: those up to its own, or up to the one that it ends.
        own = F.call_function("locate", tag, stack)
        item, group = stack_at(stack, "<li>"), stack_at(stack, "<ul>")
        ends_item = (item > 0) & ((group == 0) | (item < group))
        upto = F.when(closing, own).when(tag == "<p>", own).when((tag == "<li>") & ends_item, item).otherwise(0)
        gone = F.when(is_tag & (upto > 0), F.left(stack, upto + F.length(tag) - 1)).otherwise("")
        left = F.substr(stack, F.length(gone) + 1)
        listed = F.when(~closing & (tag == "<li>") & (stack_at(left, "<ul>") == 0), "<ul>").otherwise("")
        opened = F.when(is_tag & ~closing, F.concat(tag, listed)).otherwise("")
        shown = F.when(closing, "").when(is_tag, tag).otherwise(token)
        return F.struct(F.concat(opened, left).alias("stack"), F.concat(out, F.replace(gone, F.lit("<"), F.lit("</")), listed, shown).alias("out"))

    start = F.struct(F.lit("").alias("stack"), F.lit("").alias("out"))
    tokens = F.regexp_extract_all(_col(html), F.lit(_TAG_TOKENS), F.lit(0))
    return F.aggregate(tokens, start, step, lambda acc: F.concat(acc["out"], F.replace(acc["stack"], F.lit("<"), F.lit("</"))))


def tags_balanced(html: Column | str) -> Column:
    """Whether ``balance_tags`` would change nothing."""
    return balance_tags(html) == _col(html)


def remove_links(html: Column | str) -> Column:
    """Bare web addresses go; anchors are unwrapped, their text stays."""
    return _drop(_drop(_col(html), _URL), _ANCHOR)


def paragraph_breaks(html: Column | str) -> Column:
    """Exactly two line breaks between one paragraph and the next, outside the tags.

    Longer runs become two anywhere, shorter ones next to the end or the start of a paragraph. A single
    line break inside a text stays.
    """
    shorter = F.regexp_replace(_col(html), rf"(?i){_BR}(?:{_WS}*+{_BR}){{2,}}+", "<br><br>")
    gap = rf"(?i)</p{_WS}*+>{_WS}*+(?:{_BR}{_WS}*+)*+<p({_WS}[^<>]*)?>"
    between = F.regexp_replace(shorter, gap, "</p><br><br><p$1>")
    after = F.regexp_replace(between, rf"(?i)(</p{_WS}*+>{_WS}*+){_BR_RUN}", "$1<br><br>")
    return F.regexp_replace(after, rf"(?i){_BR_RUN}({_WS}*+{_P_OPEN})", "<br><br>$1")


def breaks_ok(html: Column | str) -> Column:
    """Whether the line breaks follow the rule, told from the runs themselves.

    No paragraph follows another directly, no run has more than two line breaks, and a run next to the end
    or the start of a paragraph has two.
    """
    html = _col(html)
    run = rf"(?i)((?:</p{_WS}*+>{_WS}*+)?+(?:{_BR}{_WS}*+)++(?:{_P_OPEN})?+)"

    def right(run: Column) -> Column:
        low = F.lower(run)
        breaks = F.length(low) - F.length(F.replace(low, F.lit("<br"), F.lit("br")))
        return (breaks == 2) | ((breaks == 1) & ~low.startswith("</p") & ~low.contains("<p"))

    joined = html.rlike(rf"(?i)</p{_WS}*+>{_WS}*+{_P_OPEN}")
    return ~joined & F.forall(F.regexp_extract_all(html, F.lit(run), F.lit(1)), right)


def labels_of(text: Column | str) -> Column:
    return F.regexp_extract_all(_col(text), F.lit(f"({_LABEL})"), F.lit(1))


def without_labels(text: Column | str) -> Column:
    return _drop(_col(text), _LABEL)


def end_labels(text: Column | str) -> Column:
    """All labels, in their order, at the very end; texts without labels stay as they are."""
    text = _col(text)
    body = F.rtrim(without_labels(text), F.lit(" \t\r\n\f"))
    found = F.array_join(labels_of(text), " ")
    last = F.concat(body, F.when(body == "", F.lit("")).otherwise(F.lit(" ")), found)
    return F.when(text.contains("[#J-") & text.rlike(_LABEL), last).otherwise(text)


def _behind(text: Column, mark: str) -> Column:
    """What follows the first ``mark``; NULL without one."""
    at = F.instr(text, F.lit(mark))
    return F.when(at > 0, F.substr(text, at + len(mark)))


def _before(text: Column, end: str) -> Column:
    """What comes before the first ``end``; NULL without one."""
    at = F.instr(text, F.lit(end))
    return F.when(at > 0, F.substr(text, F.lit(1), at - 1))


def _through(html: Column, mark: str, end: str) -> Column:
    """The text up to the first ``end`` that follows the first ``mark``; NULL without both."""
    inner = _before(_behind(html, mark), end)
    return F.substr(html, F.lit(1), F.instr(html, F.lit(mark)) + F.length(inner) + (len(mark) + len(end) - 1))


def _summary_head(html: Column) -> Column:
    """The text up to the end of the summary and the line breaks after it."""

    def to_end(lead: Column) -> Column:
        rest = F.substr(html, F.length(lead) + 1)
        inner = _before(rest, "</p>")
        breaks = F.regexp_extract(F.substr(rest, F.length(inner) + 5), "^(?:<br>)*+", 0)
        whole = F.substr(html, F.lit(1), F.length(lead) + F.length(inner) + 4 + F.length(breaks))
        return F.when(lead != "", whole)

    return _let(F.regexp_extract(html, _UP_TO_SUMMARY, 0), to_end)


def head_of(html: Column | str) -> Column:
    """The fixed head of a posting up to the last of its parts; '' if it has none."""
    html = _col(html)
    marked = reduce(Column.__or__, [html.contains(mark) for mark in (_PLACES_MARK, _CLOSING_MARK, _SUMMARY_MARK)])
    found = F.coalesce(_through(html, _PLACES_MARK, _END), _through(html, _CLOSING_MARK, _END), _summary_head(html), F.lit(""))
    return F.when(marked, found).when(html.isNotNull(), F.lit(""))


def body_of(html: Column | str) -> Column:
    """The text after the head, labels included."""
    return F.substr(_col(html), F.length(head_of(html)) + 1)


def posting_parts(html: Column | str) -> Column:
    """Company, summary, closing company, places, body and labels of a posting."""
    html = _col(html)

    def part(mark: str, end: str) -> Column:
        return F.nullif(_before(_behind(html, mark), end), F.lit(""))

    summary = _let(F.regexp_extract(html, _UP_TO_SUMMARY, 0), lambda lead: F.when(lead != "", _before(F.substr(html, F.length(lead) + 1), "</p>")))
    return F.struct(
        part(_COMPANY_MARK, "</strong>").alias("company"),
        strip(F.nullif(summary, F.lit(""))).alias("summary"),
        part(_CLOSING_MARK, f".{_END}").alias("closing_company"),
        part(_PLACES_MARK, _END).alias("places"),
        without_labels(body_of(html)).alias("body"),
        labels_of(html).alias("labels"),
    )


def _fill(template: str, **values: Column) -> Column:
    """The template with each {name} replaced by a column."""
    pieces, rest = [], template
    while rest:
        text, _, rest = rest.partition("{")
        pieces.append(F.lit(text))
        if rest:
            name, _, rest = rest.partition("}")
            pieces.append(values[name])
    return F.concat(*pieces)


def intro_wrap(
    company: Column | str, summary: Column | str, places: Column | str, body: Column | str, brand: str
) -> Column:
    """The fixed head around a given summary, then the body."""
    company = _col(company)
    return F.concat(
        _fill(INTRO, company=company),
        _fill(SUMMARY_HEAD, brand=F.lit(brand)),
        _col(summary),
        F.lit(SUMMARY_END),
        _fill(CLOSING, company=company),
        _fill(PLACES, places=_col(places)),
        _col(body),
    )


# The formatting rules for a body, in order, each with texts of which one is in every body it
# changes. Searching for them is far cheaper than a pattern. Anchors go with the other tags.
_BODY_RULES = [
    (["<!--", "<s", "<S"], drop_hidden),
    (["://"], _addresses),
    (["<h", "<H", "</h", "</H"], _headings),
    (["<o", "<O", "</o", "</O"], _ordered_lists),
    (["<"], _blocks),
    (["<"], allow_tags),
    (["<"], paragraph_breaks),
]


def format_posting(df: DataFrame, column: str) -> DataFrame:
    """``df`` with the column's head as it is, its body formatted and its labels last.

    In steps, as each one uses the text before it several times.
    """
    steps = df.withColumn("__head", head_of(column))
    steps = steps.withColumn("__text", F.substr(column, F.length("__head") + 1))
    for marks, rule in _BODY_RULES:
        text = F.col("__text")
        found = reduce(Column.__or__, [text.contains(mark) for mark in marks])
        steps = steps.withColumn("__text", F.when(found, rule(text)).otherwise(text))
    steps = steps.withColumn("__text", F.concat("__head", "__text"))
    return steps.withColumn(column, end_labels("__text")).drop("__head", "__text")


def plain_text(html: Column | str) -> Column:
    """What a reader sees: no scripts, tags, links or labels, white space squeezed."""
    text = _drop(_drop(drop_hidden(html), _URL), _ANY_TAG)
    text = without_labels(text)
    return F.trim(F.regexp_replace(text, rf"{_WS}+", " "))


def conformance(
    before: Column,
    after: Column,
    old_head: Column,
    new_head: Column,
    old_body: Column,
    new_body: Column,
    max_summary: int = SUMMARY_MAX_CHARS,
    head_required: bool = False,
) -> dict[str, Column]:
    """One boolean per formatting rule, for two texts and their heads and bodies."""
    other_tag = _drop(after, rf"(?i)</?(?:{_ALLOWED})>")
    parts = posting_parts(new_head)
    has_head = parts["company"].isNotNull() & parts["closing_company"].isNotNull() & parts["places"].isNotNull()
    fixed = (new_head == old_head) | ((new_head != "") & has_head & (parts["company"] == parts["closing_company"]))
    return {
        "tags_ok": ~other_tag.rlike(_ANY_TAG),
        "links_ok": ~new_body.rlike(r"(?i)<a[ \t\r\n\f>]|https?://[^ \t\r\n\f<>\"]"),
        "breaks_ok": breaks_ok(new_body),
        "labels_ok": F.sort_array(labels_of(before)) == F.sort_array(labels_of(after)),
        "labels_last": after == end_labels(after),
        "head_ok": F.coalesce(fixed, F.lit(False)) & (has_head if head_required else F.lit(True)),
        "text_ok": plain_text(old_body) == plain_text(new_body),
        "summary_ok": F.coalesce(F.length(plain_text(parts["summary"])) <= max_summary, F.lit(True)),
    }


RULES = ["tags_ok", "links_ok", "breaks_ok", "labels_ok", "labels_last", "head_ok", "text_ok", "summary_ok", "conforms"]
