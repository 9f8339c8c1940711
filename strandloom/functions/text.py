"""Text functions on columns. Null gives null everywhere.

Everything but entity decoding, compatibility decomposition, HTML and repaired
encodings is a Catalyst expression. Those four are Arrow functions which see
only the rows that need them; all others reach them as nulls.
"""

from __future__ import annotations

import html
import re
import unicodedata
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandloom.functions.hashing import h32

# Words that carry no meaning of their own.
STOPWORDS = ["the", "a", "an", "of", "in", "on", "for", "to", "and", "or", "is", "at", "by", "with", "from", "as", "be", "that", "this"]
SIGNATURE_STOP = [*STOPWORDS, "are", "their", "its", "these", "those"]
WORD_STOP = ["the", "a", "an", "of", "for", "and", "to", "in", "on", "at", "by", "with", "is", "are", "be", "or"]
TAG_STOP = [
    *STOPWORDS, "are", "these", "those", "their", "its", "into", "such", "than", "then", "also", "over", "under", "about", "above", "below", "between", "through", "during", "after", "before", "because", "while", "other", "which", "where", "when", "what",
    "each", "both", "some", "most", "many", "much", "more", "less", "only", "very", "just", "can", "should", "would", "could", "may", "might", "will", "shall", "does", "did", "done", "has", "have", "had",
]
# Letters that decomposition leaves whole, and their ASCII spelling.
ASCII_LETTERS = {"ß": "ss", "ø": "o", "ł": "l", "đ": "d", "ı": "i", "æ": "ae", "œ": "oe", "ð": "d", "þ": "th"}

SPACE = r"[\s\x{a0}\x{feff}\p{Z}]"
SLUG_LENGTH = 80


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it; no Python function may stand in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def trim(text: Column | str) -> Column:
    """Without outer white space of any kind."""
    return F.regexp_replace(col(text), f"^{SPACE}+|{SPACE}+$", "")


def _only(condition: Column, text: Column, function) -> Column:
    """``function`` where the condition holds, the text elsewhere; the function sees nulls for the others."""
    changed = F.arrow_udf(function, T.StringType())(F.when(condition, text))
    return F.when(condition, changed).otherwise(text)


def _each(function):
    def run(column: pa.Array) -> pa.Array:
        return pa.array([None if x is None else function(x) for x in column.to_pylist()], pa.string())

    return run


def decode_entities(text: Column | str) -> Column:
    return _only(F.contains(col(text), F.lit("&")), col(text), _each(html.unescape))


def decompose(text: Column | str) -> Column:
    """Compatibility decomposition without combining marks (U+0300 to U+036F)."""
    bare = _only(col(text).rlike(r"[^\x00-\x7f]"), col(text), _each(lambda s: unicodedata.normalize("NFKD", s)))
    return F.regexp_replace(bare, r"[\x{300}-\x{36f}]", "")


def slug_base(text: Column | str) -> Column:
    """Lower-case words of ASCII letters and digits, joined by hyphens."""
    out = F.lower(decompose(decode_entities(text)))
    for letter, plain in ASCII_LETTERS.items():
        out = F.replace(out, F.lit(letter), F.lit(plain))
    out = F.regexp_replace(out, rf"[^a-z0-9\s\x{{a0}}\x{{feff}}\p{{Z}}-]", " ")
    out = F.regexp_replace(trim(out), f"{SPACE}+", "-")
    return F.regexp_replace(F.regexp_replace(out, "-+", "-"), "^-|-$", "")


def cap_slug(base: Column | str) -> Column:
    """A slug of at most 80 characters: whole words, then six digits of its hash."""
    return let(col(base), _cap_slug)


def _cap_slug(base: Column) -> Column:
    digits = F.substring(F.lpad(F.lower(F.hex(h32(base))), 8, "0"), 1, 6)
    words = F.split(base, "-")
    room = SLUG_LENGTH - 7
    grow = lambda s, w: F.when(s["full"] | (F.length(s["text"]) + 1 + F.length(w) > room), F.struct(s["text"].alias("text"), F.lit(True).alias("full"))).otherwise(
        F.struct(F.when(s["text"] == "", w).otherwise(F.concat(s["text"], F.lit("-"), w)).alias("text"), F.lit(False).alias("full"))
    )
    kept = F.aggregate(words, F.struct(F.lit("").alias("text"), F.lit(False).alias("full")), grow)["text"]
    head = F.when(kept == "", F.substring(base, 1, 73)).otherwise(kept)
    return F.when(F.length(base) <= SLUG_LENGTH, base).otherwise(F.concat(head, F.lit("-"), digits))


def slugify(text: Column | str) -> Column:
    return cap_slug(slug_base(text))


def fuzzy_key(text: Column | str) -> Column:
    """What two titles of one skill share: no accents, case, asides or punctuation."""
    out = F.regexp_replace(F.lower(decompose(text)), r"\([^)]*\)", " ")
    return F.trim(F.regexp_replace(out, "[^a-z0-9]+", " "))


def plain_words(text: Column | str) -> Column:
    return F.filter(F.split(F.lower(col(text)), "[^a-z0-9]+"), lambda w: w != "")


def fold_word(w: Column) -> Column:
    n = F.length(w)
    cut = lambda k: F.substring(w, F.lit(1), n - k)
    return (
        F.when((n > 4) & w.endswith("ies"), F.concat(cut(3), F.lit("y")))
        .when((n > 5) & w.endswith("ing"), cut(3))
        .when((n > 4) & w.endswith("ed"), cut(2))
        .when((n > 3) & w.endswith("s") & ~w.endswith("ss"), cut(1))
        .otherwise(w)
    )


def fold_key(text: Column | str) -> Column:
    """A title without plurals and -ing or -ed endings."""
    return F.array_join(F.transform(plain_words(text), fold_word), " ")


def token_signature(text: Column | str) -> Column:
    """Sorted words of a title; equal for titles that differ in order and stop words."""
    keep = lambda w: (F.length(w) >= 2) & ~w.isin(SIGNATURE_STOP) & ((F.length(w) >= 3) | w.rlike("[0-9]"))
    return F.array_join(F.array_sort(F.filter(plain_words(text), keep)), " ")


def signature_words(text: Column | str) -> Column:
    return F.array_distinct(F.filter(plain_words(text), lambda w: (F.length(w) >= 3) & ~w.isin(SIGNATURE_STOP)))


def word_set(text: Column | str) -> Column:
    return F.array_distinct(F.filter(plain_words(text), lambda w: (F.length(w) >= 2) & ~w.isin(WORD_STOP)))


def tag_words(text: Column | str) -> Column:
    """Words of four or more letters, and the singular of plurals of five or more."""
    words = F.filter(plain_words(text), lambda w: (F.length(w) >= 4) & ~w.isin(TAG_STOP))
    plural = F.filter(words, lambda w: (F.length(w) >= 5) & w.endswith("s") & ~w.endswith("ss"))
    return F.array_union(words, F.transform(plural, lambda w: F.substring(w, F.lit(1), F.length(w) - 1)))


def jaccard(a: Column | str, b: Column | str) -> Column:
    """Jaccard similarity of two word sets; 0 if one is empty."""
    a, b = col(a), col(b)
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both / (F.size(a) + F.size(b) - both))


def overlap(a: Column | str, b: Column | str) -> Column:
    """Common words over the words of the smaller set; null if one is empty."""
    a, b = col(a), col(b)
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.least(F.size(a), F.size(b)))


# --- cleaning of titles and statements ---------------------------------------------------------


def collapse(text: Column) -> Column:
    return trim(F.regexp_replace(text, f"{SPACE}+", " "))


def normalize_text(text: Column | str, decode: bool = True) -> Column:
    """Straight quotes and hyphens, no bold marks, single blanks."""
    out = decode_entities(text) if decode else col(text)
    out = F.translate(out, "‘’‚‛“”„‟‐‑‒–—", "''''\"\"\"\"-----")
    return collapse(F.regexp_replace(out, r"\*\*([^*]+)\*\*", "$1"))


# The rewrites of a title, in their order.
NOISE = [
    (r"(?i)\s*\((?:e\.g\.|i\.e\.)[^)]*\)", ""), (r"\s*\([^)]{60,}\)", ""), (r"(?i),?\s+such as\b[^.]*\.?\z", "."), (r"(?i)^(perform|conduct|provide|ensure|coordinate)\s+(the|an?|of)\s+", "$1 "),
    (r"[\s:;\-–—]+\z", ""), (r"^[•▪►■◆]\s*", ""), (r"^\d+\.\s+", ""), (r"\s+\([A-Z]\)\z", ""), (r"(?i)\s+\(Supplemental\)\z", ""), (r"\.\z", ""), (r"(?i);?\s+and\z", ""), (r"\$([^$]+)\$", "$1"), (r"\\bmod\b", "mod"), (r"\\small\b\s*", ""),
]


def denoise_title(text: Column | str) -> Column:
    out = col(text)
    for pattern, by in NOISE:
        out = F.regexp_replace(out, pattern, by)
    return collapse(out)


def upper_first(text: Column | str) -> Column:
    text = col(text)
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substring(text, F.lit(2), F.length(text)))


# Leads that say who learns, not what.
STUDENT_LEADS = [r"(?i)^(the\s+)?students?\s+will\s+(be\s+able\s+to\s+)?", r"(?i)^students?\s+can\s+", r"(?i)^by\s+the\s+end\s+of[^,.]+,\s*", r"(?i)^upon\s+completion[^,.]+,\s*", r"(?i)^(tswbat|swbat)[:\s]+"]


def strip_student_lead(text: Column | str) -> Column:
    """Without a lead such as "Students will be able to"; the text itself if nothing is left."""
    out = col(text)
    for pattern in STUDENT_LEADS:
        out = F.regexp_replace(out, pattern, "")
    return let(trim(out), lambda t: F.when(t == "", col(text)).otherwise(upper_first(t)))


def strip_question(text: Column | str) -> Column:
    """Without a question's lead and mark; an empty result is null."""
    out = F.regexp_replace(F.regexp_replace(col(text), r"(?i)^(Can|Could|Should|How to|What is|Why does)\s+", ""), r"\?\z", "")
    return F.when(out != "", upper_first(out))


# Scaffold leads and emphasis marks of statements.
_LEAD = r"(?:verbal\s+)?(?:modeling|prompting|prompts|guidance|support)\b"
SCAFFOLD = rf"(?i)^[*_]*with\s+{_LEAD}(?:(?:\s*,\s*|\s+)(?:(?:and|or)\s+)?{_LEAD})*[^,*_]*[,*_][,*_\s]*"
SCAFFOLD_BARE = rf"(?i)^with\s+{_LEAD}(?:\s+(?:(?:and|or)\s+)?{_LEAD})*\s+(?!(?:from|of|by|as|in|at|for|to|the|an?|and|or)\b)(?=\S)"
EMPHASIS = r"""(^|[\s("'“])[*_]+([^*_\s](?:[^*_]*[^*_\s])?)[*_]+(?=[\s,.;:)!?"'”]|$)"""


def unmark(text: Column | str) -> Column:
    """Without scaffold leads, emphasis and bullet stars."""
    return let(col(text), _unmark)


def _unmark(text: Column) -> Column:
    out = F.regexp_replace(text, r"^\*\s+", "")
    out = F.when(text.rlike("[,*_]"), F.regexp_replace(out, SCAFFOLD, "")).otherwise(F.regexp_replace(out, SCAFFOLD_BARE, ""))
    return F.regexp_replace(F.regexp_replace(out, EMPHASIS, "$1$2"), r"^\*+\s*", "")


def _last_stop(head: Column) -> Column:
    """0-based place of the last sentence end in a text, -1 if none."""
    last = lambda mark: F.when(F.contains(head, F.lit(mark)), F.length(head) - F.length(F.substring_index(head, mark, -1)) - 2).otherwise(-1)
    return F.greatest(last(". "), last("? "), last("! "))


def _cut(text: Column, cap: int, least: float, hard: int) -> Column:
    head, words = F.substring(text, 1, cap), F.substring(text, 1, hard)
    stop = _last_stop(head)
    blank = F.when(F.contains(words, F.lit(" ")), F.length(words) - F.length(F.substring_index(words, " ", -1)) - 1).otherwise(-1)
    whole = F.when(blank > least, F.substring(words, F.lit(1), blank)).otherwise(words)
    return F.when(F.length(text) <= cap, text).when(stop > least, trim(F.substring(text, F.lit(1), stop + 1))).otherwise(F.concat(trim(whole), F.lit("…")))


def truncate_title(text: Column | str, cap: int = 300) -> Column:
    """Cut at a sentence end or a word in the second half, else hard."""
    return let(col(text), lambda t: _cut(t, cap, cap * 0.5, cap))


def display_title(title: Column | str, tags: Column | str) -> Column:
    """A title of at most 80 characters; a long one gives way to its code, else it is cut."""
    title = col(title)
    codes = F.filter(F.transform(F.filter(F.split(col(tags), ","), lambda t: t.startswith("code:")), lambda t: trim(F.substring(t, F.lit(6), F.length(t)))), lambda c: (c != "") & (F.length(c) <= 80))
    return F.when(F.length(title) <= 80, title).otherwise(F.coalesce(F.try_element_at(codes, F.lit(1)), _cut(title, 80, 30, 79)))


# Fixed value: replies that refuse to define.
REFUSAL = r"(?i)(cannot|unable to|not familiar with|not (?:able|aware|sure)|do(?:n't| not) have|no (?:recognized |clear |standard )?(?:definition|meaning)|without (?:more |further |additional )?(?:context|information)|could you (?:provide|clarify|specify)|recognized definition|clear workplace skill)"
# Fixed value: words that only an untranslated Portuguese answer holds.
PORTUGUESE = r"(?iu)\b(?:não|para|uma|pelos?|pelas?|dos|das)\b|ções\b"


def is_summary(text: Column | str) -> Column:
    """Whether an answer is short enough for a title: at most 15 words and a slug of at most 80 characters."""
    words = F.filter(F.split(col(text), f"{SPACE}+"), lambda w: w != "")
    return (F.size(words) <= 15) & (F.length(slug_base(text)) <= SLUG_LENGTH)


def is_translation(text: Column | str) -> Column:
    """Whether an answer is one line of text without Portuguese function words; false for null."""
    text = col(text)
    return F.coalesce((trim(text) != "") & ~text.rlike(PORTUGUESE) & ~text.rlike(r"[\t\r\n]"), F.lit(False))


def clean_definition(text: Column | str, refusal: str = REFUSAL) -> Column:
    """A definition without outer marks; refusals and "skip" are empty; at most 400 characters."""
    out = F.regexp_replace(trim(text), r"""^[\s"'*_-]+|[\s"'*_-]+\z""", "")
    out = F.regexp_replace(out, f"{SPACE}+", " ")
    return let(out, lambda t: F.when(t.rlike(refusal) | (F.lower(t) == "skip"), "").otherwise(_cut(t, 400, 200, 400)))


# Descriptions that say nothing of the skill, and labels before one.
BOILERPLATE = [
    r"(?i)^The SCED provides a series of unused codes", r"(?i)We took this down", r"(?i)^\*\*(See |Standards (related|that))", r"(?i)^(\*\*)?Big Idea:", r"(?i)^Modeling is best interpreted not as a collection",
    r"(?i)On the state assessment, items measuring", r"(?i)^Students need not use formal", r"(?i)^Examples may include but are not limited", r"^\d\.$",
]
DESCRIPTION_LABEL = r"(?i)^(Progression|Clarification|Note|Sample|Sample Problem)\s*:\s*"


def clean_description(text: Column | str) -> Column:
    """Empty for boilerplate; else without a label in front."""
    text = col(text)
    empty = F.lit(False)
    for pattern in BOILERPLATE:
        empty = empty | text.rlike(pattern)
    return F.when(text.isNull(), None).when(empty, "").otherwise(F.regexp_replace(text, DESCRIPTION_LABEL, ""))


# What no statement of a skill looks like.
CODE = r"^[A-Z0-9–—-][\w.–—-]*\z"
SCAFFOLD_TITLES = [
    r"(?i)^DEPRECATED\b", r"(?i)^(?:Use the (?:clock|timer)|Click the|Press the|Drag the|Open the app)", r"(?i)^(?:Constructed Response|Hook Activity|Background Information|Vocabulary Activity|Document Analysis)\s*:",
    r"(?i)^(?:Sample Problem|Example)\s*:", r"(?i)^Particular Topics in ", r"(?i)^(?:CFItemType|Course|Subject)\s*:", r"(?i)\?\s*(?:Hook Activity|Background Information|Vocabulary Activity|Document Analysis|Writing)\z",
    r"(?i)\s+(?:Hook Activity|Writing Activity|Vocabulary Activity|Assessment Activity)\z", r"(?i)^(?:Unit|Lesson|Chapter|Benchmark|Standard)\s+[\d.]*", r"(?i)^with\s+(?:prompting|guidance|support)\b", r"(?i)^by\s+(?:date|the\s+end\s+of)\b", r"(?i)^(?:train|instruct|teach)\s+\w+s?\s+to\b",
]
SCAFFOLD_HEADS = r"(?i)^(\s*)?(grade|kindergarten|pre-?k|elementary|middle school|high school|[0-9]+(st|nd|rd|th)\s+grade|unit\s+\d|chapter\s+\d|section\s+\d|module\s+\d|standard\s+\d|topic\s+\d|strand|domain)\b"
LEVEL_HEAD = r"(?i)^(Essential|Proficient|Advanced|Intermediate|Beginning|Emerging|Developing|Extending|Exceeding|Level)\s+[IVX0-9]+"
PURE_VERB = r"(?i)^(understand|recognize|demonstrate|apply|identify|know|explain|describe)\s+(the|how|that|what|why|when|where|a|an)\s"
DESCRIPTION_LEAD = r"(?i)^(Students?\s+(will|demonstrate)|The student|This unit|Module \d+|The course|Courses)\s[^.]*?\.\s+"


def clean_statement(statement: Column | str, abbreviation: Column | str, notes: Column | str, typed: Column) -> Column:
    """A struct ``status, title, description, truncated``; status is ``row``, ``scaffold`` or ``verb``."""
    full, short, more = (F.coalesce(col(c), F.lit("")) for c in (statement, abbreviation, notes))
    by_short = (short != "") & ((full == "") | (F.length(short) < F.length(full))) & ~((F.length(short) <= 20) & short.rlike(CODE))
    title = F.when(by_short, short).otherwise(full)
    description = F.when(by_short, F.when((full != "") & (full != short), full).otherwise(more)).otherwise(F.when(more != full, more).otherwise(""))
    for pattern in (r"^[•▪►■◆]\s*", r"^\d+\.\s+", r"^[A-Z][A-Za-z0-9]*(\.[A-Za-z0-9]+)+:\s+"):
        title = F.regexp_replace(title, pattern, "")
    title = let(unmark(title), lambda t: F.when(t == "", "").otherwise(strip_student_lead(t)))
    title = F.regexp_replace(title, r"(?i)^((I can,?|Can|Could|Should|How to|What is|Why does)\s+)+", "")
    title = let(title, lambda t: trim(F.regexp_replace(upper_first(t), r"(?i)^(Benchmark|Standard|Indicator)\s+[\d.]+\s*:\s*", "")))
    both = F.struct(title.alias("title"), F.regexp_replace(description, DESCRIPTION_LEAD, "").alias("description"), ((full == "") & (short == "")).alias("none"), typed.alias("typed"))
    return let(both, _judge_statement)


def _judge_statement(given: Column) -> Column:
    cut = F.struct(truncate_title(given["title"], 300).alias("title"), given["description"].alias("description"), given["none"].alias("none"), given["typed"].alias("typed"), (F.length(given["title"]) > 300).alias("long"))
    return let(cut, _statement_status)


def _statement_status(given: Column) -> Column:
    title, typed = given["title"], given["typed"]
    n = F.length(title)
    simple = F.lit(False)
    for pattern in SCAFFOLD_TITLES:
        simple = simple | title.rlike(pattern)
    scaffold = (
        given["none"] | (n <= 2) | ((n <= 20) & title.rlike(CODE)) | simple | (title.rlike(LEVEL_HEAD) & (n < 30)) | (title.rlike(r"(?i)^You\s+[a-z]") & (n > 20))
        | (~title.rlike(r"\s") & (n < 30)) | (title.rlike(SCAFFOLD_HEADS) & (n < 50) & ~typed)
    )
    verb = title.rlike(PURE_VERB) & (n < 60) & ~typed
    status = F.when(scaffold, "scaffold").when(verb, "verb").otherwise("row")
    return F.struct(status.alias("status"), title.alias("title"), given["description"].alias("description"), given["long"].alias("truncated"))


# --- encodings and markup ------------------------------------------------------------------------


def _cp1252() -> dict[str, int]:
    out = {}
    for b in range(0x80, 0x100):
        try:
            out[bytes([b]).decode("cp1252")] = b
        except UnicodeDecodeError:
            out[chr(b)] = b
    return out


def _repair(text: str) -> str:
    table = _cp1252()

    def run(match: re.Match) -> str:
        try:
            return bytes(table[c] for c in match.group()).decode("utf-8")
        except UnicodeDecodeError:
            return match.group()

    return re.sub("[" + "".join(map(re.escape, table)) + "]+", run, text)


def repair_encoding(text: Column | str) -> Column:
    """UTF-8 that was once read as cp1252 ("rÃ©sumÃ©") gets its letters back; anything else stays."""
    return _only(col(text).rlike(r"[^\x00-\x7f]"), col(text), _each(_repair))


# Elements that part words, and elements that no statement may hold.
BLOCKS = {"br", "p", "div", "li", "ul", "ol", "tr", "td", "th", "table", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6"}
FOREIGN = {"script", "style", "title", "meta", "link", "base"}


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.foreign: str | None = None

    def handle_starttag(self, tag, attrs):
        if tag in FOREIGN:
            self.foreign = tag
        if tag in BLOCKS:
            self.parts.append(" ")

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_data(self, data):
        self.parts.append(data)


def _plain(markup: str) -> str:
    parser = _Text()
    parser.feed(markup)
    parser.close()
    if parser.foreign:
        raise ValueError(f"a statement holds a <{parser.foreign}> element: {markup[:120]!r}")
    return "".join(parser.parts)


def html_text(text: Column | str) -> Column:
    """The text of markup, with a blank before block elements; a script, style or head element is an error."""
    return _only(col(text).rlike("[<&]"), col(text), _each(_plain))


def strip_controls(text: Column | str) -> Column:
    """Without control and zero-width characters."""
    return F.regexp_replace(col(text), r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f\x{200b}-\x{200d}\x{2060}\x{feff}]", "")


# --- codes, grades, courses ----------------------------------------------------------------------


def code_tag(raw: Column | str) -> Column:
    code = F.regexp_replace(trim(raw), r"(?i)^Khan\s+", "")
    return F.when((F.length(code) >= 4) & code.rlike(r"[A-Z.]"), F.concat(F.lit("code:"), code))


def normal_grade(grade: Column | str) -> Column:
    g = F.upper(trim(grade))
    return F.when(g.isin("KG", "TK"), "K").when(g.isin("PR", "PRE-K", "PRE-KINDERGARTEN"), "PK").otherwise(g)


def grade_difficulty(token: Column | str) -> Column:
    """A grade token on the scale of difficulty: PK 0, K 1, grade n is n + 1, technical 14, college 15; else null."""
    t = trim(F.upper(col(token)))
    number = F.regexp_extract(t, r"^0?(\d{1,2})\z", 1)
    return (
        F.when(t.isin("PK", "PR", "PRE-K", "EC"), 0).when(t.isin("KG", "K"), 1).when(number.try_cast("int").between(1, 12), number.try_cast("int") + 1)
        .when(t.isin("IT", "CTE"), 14).when(t.rlike("AP|COLLEGE|UG|UNDERGRAD"), 15)
    )


def tag_grades(tags: Column | str) -> Column:
    """All difficulties that ``grade:`` tags of a comma-joined list name."""
    parts = F.flatten(F.transform(F.regexp_extract_all(col(tags), F.lit("grade:([^,]+)"), 1), lambda g: F.split(g, r"\.")))
    return F.filter(F.transform(parts, grade_difficulty), lambda d: d.isNotNull())


# What wraps the topic of a course title.
COURSE_LEAD = r"(?i)^(?:(?:an?|the)\s+)?(?:introduction to|introductory|intro to|fundamentals of|principles of|foundations of|elements of|basics of|basic|survey of|topics in|special topics in|selected topics in|seminar in|seminar on|advanced topics in|advanced|elementary|intermediate|general|essentials of|honou?rs)\s+(?:the\s+)?"
COURSE_TAIL = r"(?i)(?:\s*[-–:,(]\s*|\s+)(?:i{1,3}|iv|vi{0,3}|ix|x|\d{1,3}[a-z]?|[a-d]|part \w+|level \w+|lab(?:oratory)?|practicum|workshop|seminar|studio|tutorial|clinical|lecture|capstone|honou?rs|for [\w ,&'/-]*?(?:engineer(?:s|ing)|students|majors|teachers|educators|nurses|translators|planners|managers|scientists|professionals|beginners|architects|designers|technologists))\)?\z"
DANGLING = r"(?i)\b(?:and|of|to|in|for|from|the|with|or)\z"


def course_topic(title: Column | str) -> Column:
    """The topic of a course title, by at most four passes; never left with a dangling connector."""
    out = F.regexp_replace(col(title), r"^[\s–-]+", "")
    for _ in range(4):
        lead = let(out, lambda t: F.coalesce(F.nullif(F.regexp_replace(t, COURSE_LEAD, ""), F.lit("")), t))
        out = let(lead, _without_tail)
    return out


def _without_tail(lead: Column) -> Column:
    tail = F.regexp_replace(F.regexp_replace(lead, COURSE_TAIL, ""), r"[\s,:&-]+\z", "")
    return let(tail, lambda t: F.when((t != "") & ~t.rlike(DANGLING), t).otherwise(lead))


def plain_label(text: Column | str) -> Column:
    """A label without underscores and asides."""
    return collapse(F.regexp_replace(F.translate(col(text), "_", " "), r"\([^)]*\)", " "))
