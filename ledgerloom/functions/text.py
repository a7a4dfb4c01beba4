"""Scalar functions on labels, titles and amounts, as Column expressions; no Python code runs for a row."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Phrases that name a subcommittee, tried in this order.
SUBCOMMITTEES = {
    "Agriculture": ("agriculture", "rural development", "food and drug"),
    "Commerce-Justice-Science": ("commerce, justice", "science, and related"),
    "Defense": ("department of defense appropriations", "defense appropriations"),
    "Energy-Water": ("energy and water",),
    "Financial-Services": ("financial services", "general government"),
    "Homeland-Security": ("homeland security",),
    "Interior-Environment": ("interior, environment", "interior and environment", "department of the interior"),
    "Labor-HHS-Education": ("labor, health", "human services", "education, and related"),
    "Legislative-Branch": ("legislative branch",),
    "MilCon-VA": ("military construction", "veterans affairs"),
    "State-Foreign-Ops": ("state, foreign operations", "foreign operations", "department of state, and related programs"),
    "THUD": ("transportation, housing", "urban development", "transportation, and housing"),
}
# Where a title says its fiscal year, by priority.
YEAR_PATTERNS = (r"(?i)(?:bill|act)s?,?\s+(\d{4})", r"(?i)september\s+30,\s+(\d{4})", r"(?i)fiscal\s+year\s+(\d{4})", r"(?i)appropriations?,\s+(\d{4})")
# Designations and the patterns that show them, by priority.
DESIGNATIONS = (
    ("OCO", r"(?i)\b(oco|overseas contingency)"),
    ("emergency", r"(?i)\bemergenc"),
    ("disaster", r"(?i)\bdisaster (relief|designation)"),
    ("CHIMP", r"(?i)\bchange[ds]? in mandatory|\bchimp"),
    ("rescission", r"(?i)\brescis|\bcancellation"),
)
# Words that no token set holds, by use.
STOP_WORDS = {
    "tier": "the of and for to a an in on fund funds account program office national salaries expenses department bureau administration".split(),
    "title": "the of and for to a an in on at by salaries expenses account accounts fund funds revolving appropriation appropriations".split(),
    "recall": "of the and for office to in a".split(),
}
# Shortest token of each use.
TOKEN_LENGTH = {"tier": 4, "title": 3, "recall": 2, "context": 1}
# Spellings of subcommittees that are made equal.
CANONICAL = {"Homeland Security": "Homeland-Security", "State-Foreign-Ops": "State-Foreign-Operations"}
# First words that lost a decorative letter.
DROPCAPS = {"ENSION": "P", "FFICE": "O", "DUCATION": "E"}

_WHITE = " \t\n\r\f\x0b"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_WHITE))


def first_match(c: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match; null without one."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def first_of(*cases: tuple[Column, Column | str], otherwise: Column | str | None = None) -> Column:
    """The value of the first condition that holds."""
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return reduce(lambda rest, case: F.when(case[0], as_col(case[1])).otherwise(rest), reversed(cases), as_col(otherwise))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where a value that is used several times is evaluated once."""
    return F.get(F.transform(F.array(value), use), 0)


# ---- amounts -------------------------------------------------------------------------------------------------------

# Fixed value: an amount; dots, dashes and blanks alone hold none.
_AMOUNT = r"(\()?([+\-])?\$?([\d,]+)(\))?"


def parse_dollar(raw: Column, in_thousands: Column | bool = False, *, paren_negative: bool) -> Column:
    """struct<value, raw_text, in_thousands>. Dots, dashes and blanks are null; an explicit sign wins over parentheses, which are negative only if asked for."""
    thousands = in_thousands if isinstance(in_thousands, Column) else F.lit(in_thousands)
    found = F.regexp_extract(raw, _AMOUNT, 0)  # matched once; what is read from it are plain characters
    value = F.translate(found, "()+$,", "").try_cast("bigint")
    if paren_negative:
        value = value * F.when(found.rlike(r"^\(\$?[\d,]+\)$"), -1).otherwise(1)
    value = value * F.when(thousands, 1000).otherwise(1)
    return F.struct(value.cast("bigint").alias("value"), raw.alias("raw_text"), thousands.alias("in_thousands"))


def token_amount(raw: Column, in_thousands: Column) -> Column:
    """parse_dollar() of what is an amount as a whole, or dots: parentheses are no negative."""
    value = F.translate(raw, "()+$,.", "").try_cast("bigint") * F.when(in_thousands, 1000).otherwise(1)
    return F.struct(value.cast("bigint").alias("value"), raw.alias("raw_text"), in_thousands.alias("in_thousands"))


def parse_dollar_columns(line: Column, positions: list[tuple[int, int]], in_thousands: bool = False, *, paren_negative: bool) -> Column:
    """An array of amounts cut from fixed columns [start, end)."""
    return F.array(*[parse_dollar(F.substring(line, a + 1, b - a), in_thousands, paren_negative=paren_negative) for a, b in positions])


def is_paren_memo(amount: Column) -> Column:
    """M1: a positive amount printed in parentheses without a minus."""
    raw = strip(F.coalesce(amount["raw_text"], F.lit("")))
    return F.coalesce((amount["value"] > 0) & raw.startswith("(") & ~raw.contains("-"), F.lit(False))


def is_paren_amount(raw: Column) -> Column:
    """M2: printed in parentheses, whatever the sign."""
    return strip(F.coalesce(raw, F.lit(""))).startswith("(")


def is_memo_label(label: Column) -> Column:
    """M3: the whole label is in parentheses."""
    return F.coalesce(label, F.lit("")).rlike(r"^\s*\(.*\)\s*$")


def is_memo_row(label: Column, raw: Column) -> Column:
    """M4: label or amount begins with a parenthesis."""
    return strip(F.coalesce(label, F.lit(""))).startswith("(") | is_paren_amount(raw)


# ---- labels --------------------------------------------------------------------------------------------------------


# How the five kinds of totals begin, and what follows the word in a name.
_LINE_TOTAL = r"(?i)^(sub)?total(,| |--|$)"
_MARKED_TOTAL = r"(?i)^\s*(?:sub)?total\b[.,:]"
_ANY_TOTAL = r"(?i)^\s*\(?(sub)?total\b"
_BARE_TOTAL = r"(?i)^(sub)?total\b"
_TYPESET_TOTAL = r"^TOTAL.*?(\s+[+-]?[\d,]+){3,}\s*$"
_TOTAL_OF = r"(?is)^\s*(?:sub)?total\b[.,:]?\s*(.*?)\s*$"


def is_subtotal_line(text: Column) -> Column:
    """T1."""
    return strip(text).rlike(_LINE_TOTAL)


def is_rollup(flag: Column, text: Column) -> Column:
    """T2: flagged, or total followed by punctuation."""
    return F.coalesce(flag, F.lit(False)) | F.coalesce(text, F.lit("")).rlike(_MARKED_TOTAL)


def is_total(flag: Column, text: Column) -> Column:
    """T3: flagged, or begins with total, also in parentheses."""
    return F.coalesce(flag, F.lit(False)) | F.coalesce(text, F.lit("")).rlike(_ANY_TOTAL)


def is_enacted_total(label: Column) -> Column:
    """T4."""
    return label.rlike(_BARE_TOTAL)


def is_typeset_total(text: Column) -> Column:
    """T5: TOTAL with at least three trailing amounts."""
    return text.rlike(_TYPESET_TOTAL)


def rollup_name(text: Column) -> Column:
    """The name after (sub)total; null for a bare one."""
    return F.nullif(F.btrim(F.regexp_extract(F.coalesce(text, F.lit("")), _TOTAL_OF, 1), F.lit(" .:,")), F.lit(""))


# Amounts that have leaked into the end of a label, what a piece of a label begins or ends with and how short it is, and where qualifiers stand.
_LEAKED = r"(?:\s+\$?\d{1,3}(?:[ ,]\d{3})*)+\s*$"
_PIECE = (r"^\p{Ll}", r"[,/\-]$", r"(?i)^(and|or|the|of|operations|relief|appropriation)\b")
_SHORT = 4
_PARENS = r"[(\[][^)\]]*[)\]]"
_TRAILING = r"(?i),\s*(base|emergency|oco|disaster|rescission)\b.*$"


def label_parts(raw: Column) -> Column:
    """What a printed label says: struct<stripped, normalized, designation, is_fragment>.

    stripped: without leaked amounts; years within a name stay. normalized: the name to match by, without qualifiers, in small letters, digits and single spaces.
    designation: what its parentheses and trailing qualifier say of the money. is_fragment: only a piece of a label, by its length, its ends or an unopened bracket.
    """
    stripped = strip(F.regexp_replace(raw, _LEAKED, ""))
    name = F.lower(F.regexp_replace(F.regexp_replace(stripped, _PARENS, ""), _TRAILING, ""))
    normalized = strip(F.regexp_replace(F.regexp_replace(name, "[^a-z0-9 ]", " "), r"\s+", " "))
    said = F.concat_ws(" ", F.array_join(F.regexp_extract_all(raw, F.lit(f"({_PARENS})"), 1), " "), F.regexp_extract(raw, _TRAILING, 0))
    designation = once(said, lambda v: first_of(*[(v.rlike(pattern), kind) for kind, pattern in DESIGNATIONS], otherwise="base"))
    without = lambda v, c: F.length(F.replace(v, F.lit(c), F.lit("")))
    unopened = lambda v: (without(v, ")") < without(v, "(")) | (without(v, "]") < without(v, "["))
    piece = once(stripped, lambda v: reduce(lambda a, b: a | b, [v.rlike(p) for p in _PIECE], unopened(v) | (F.length(v) < _SHORT)))
    return F.struct(stripped.alias("stripped"), normalized.alias("normalized"), designation.alias("designation"), piece.alias("is_fragment"))


def tokens(text: Column, kind: str) -> Column:
    """The distinct words of a label for one of the uses in TOKEN_LENGTH."""
    word = r"([a-z]+)" if kind == "tier" else r"([a-z0-9]+)"
    found = F.filter(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(word), 1), lambda w: F.length(w) >= TOKEN_LENGTH[kind])
    stop = STOP_WORDS.get(kind)
    return F.array_distinct(F.array_except(found, F.array(*map(F.lit, stop))) if stop else found)


def recall_name(name: Column) -> Column:
    s = F.regexp_replace(F.coalesce(name, F.lit("")), r"(?i)^\s*(sub)?total[,:]?\s*", "")
    return strip(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " "))


def norm_title(t: Column) -> Column:
    return strip(F.regexp_replace(F.lower(t), "[^a-z0-9]+", " "))


def classify_title_change(before: Column, now: Column) -> Column:
    """case, prefix or reword."""
    a, b = F.filter(F.split(norm_title(before), " "), lambda w: w != ""), F.filter(F.split(norm_title(now), " "), lambda w: w != "")
    leads = lambda x, y: F.slice(x, F.lit(1), F.size(y)) == y
    return first_of((norm_title(before) == norm_title(now), "case"), (leads(a, b) | leads(b, a), "prefix"), otherwise="reword")


def canon_subcommittee(v: Column) -> Column:
    return first_of(*[(v == k, n) for k, n in CANONICAL.items()], otherwise=v)


# ---- titles and reports --------------------------------------------------------------------------------------------


def classify_subcommittee(title: Column) -> Column:
    low = F.lower(title)
    return first_of(*[(low.contains(p), name) for name, phrases in SUBCOMMITTEES.items() for p in phrases])


def extract_fiscal_year(title: Column) -> Column:
    return F.coalesce(*[first_match(title, p) for p in YEAR_PATTERNS]).cast("int")


def classify_stage(title: Column) -> Column:
    low = F.lower(title)
    return F.when(low.contains("conference") | low.contains("joint explanatory"), "conference").otherwise("committee")


def is_report_title(title: Column) -> Column:
    t = F.replace(F.lower(title), F.lit("- "), F.lit(""))
    return t.contains("appropriation") & ~t.contains("consideration")


def chamber_of_class(doc_class: Column) -> Column:
    return first_of((doc_class == "HRPT", "house"), (doc_class == "SRPT", "senate"))


def report_number(package_id: Column) -> Column:
    return F.regexp_extract(package_id, r"rpt(\d+)$", 1).try_cast("int")


def congress_of_year(year: Column) -> Column:
    return (F.lit(114) + F.floor((year - 2016) / 2)).cast("int")


def years_of_congress(congress: Column) -> Column:
    first = (congress - 114) * 2 + 2016
    return F.array(first.cast("int"), (first + 1).cast("int"))


# ---- text layout ---------------------------------------------------------------------------------------------------


def detect_indent(line: Column) -> Column:
    return F.length(line) - F.length(F.ltrim(line, F.lit(_WHITE)))


def is_upper(text: Column) -> Column:
    """Has a cased letter, and none in lower case."""
    return (F.upper(text) == text) & (F.lower(text) != text)


#: Levels of the printed hierarchy.
TITLE, DEPARTMENT, AGENCY, ACCOUNT, PROGRAM, SUBPROGRAM = range(6)


def hierarchy_level(text: Column, indent: Column) -> Column:
    """The level of a fixed-width statement's row."""
    s = strip(text)
    head = F.rtrim(strip(F.substring_index(s, "...", 1)), F.lit("."))
    caps = ~head.rlike("[a-z]") & is_upper(F.translate(head, ",- ()", ""))
    return first_of((s == "", F.lit(TITLE)), (s.rlike(r"^TITLE\s+[IVXLC]+"), F.lit(TITLE)), (caps, F.when(indent < 8, DEPARTMENT).otherwise(AGENCY)), (s.endswith(":"), F.lit(ACCOUNT)), (indent < 4, F.lit(ACCOUNT)), (indent < 8, F.lit(PROGRAM)), otherwise=F.lit(SUBPROGRAM))


def detect_hierarchy_level(line: Column, indent: Column) -> Column:
    """The level of any line by indentation alone."""
    s = strip(line)
    return first_of((s == "", F.lit(TITLE)), (s.rlike(r"^TITLE\s+[IVXLC]+"), F.lit(TITLE)), (is_upper(s) & (indent < 8), F.lit(DEPARTMENT)), (is_upper(s), F.lit(AGENCY)), (indent < 16, F.lit(ACCOUNT)), (indent < 24, F.lit(PROGRAM)), otherwise=F.lit(SUBPROGRAM))


def repair_dropcap(heading: Column) -> Column:
    first = F.element_at(F.split(strip(heading), "[ ,]", 2), 1)
    return F.concat(first_of(*[(first == k, v) for k, v in DROPCAPS.items()], otherwise=""), heading)


def label_type(label: Column, indent: Column, compared: Column) -> Column:
    """Which amount a line of an inline table states; compared: it stands below 'Bill compared with:'."""
    return kind_of_label(F.lower(strip(label)), indent, compared)


def kind_of_label(low: Column, indent: Column, compared: Column) -> Column:
    """The same of a label that is stripped and in small letters."""
    begins = lambda *starts: reduce(lambda a, b: a | b, [low.startswith(s) for s in starts])
    prior, budget = begins("appropriation,", "appropriations,"), begins("budget estimate", "budget request")
    return first_of((compared & (indent >= 4) & prior, "delta_vs_enacted"), (compared & (indent >= 4) & budget, "delta_vs_estimate"), (compared, F.lit(None).cast("string")), (prior, "prior_year"), (budget, "budget_estimate"), (begins("committee recommendation", "recommended in the bill"), "committee_recommendation"))


def is_thousands_marker(line: Column) -> Column:
    """A table's units header: a short line with a bracketed 'thousand'."""
    return (line.contains("[") | line.contains("(")) & (F.length(line) < 45) & line.rlike(r"(?i)[\[(][^\[\]()]{0,40}thousand[^\[\]()]{0,24}[\])]")


def join_split_numbers(s: Column) -> Column:
    return F.when(s.rlike(r"\s,|,\s"), F.regexp_replace(F.regexp_replace(s, r"(\d)\s+,", "$1,"), r",\s+(\d)", ",$1")).otherwise(s)


def caps_fraction(label: Column) -> Column:
    letters = F.length(F.regexp_replace(label, r"\P{L}+", ""))
    return F.when(letters > 0, F.length(F.regexp_replace(label, r"\P{Lu}+", "")) / letters).otherwise(0.0)


def label_before(line: Column, first: Column, rest: str) -> Column:
    """What stands before the amounts of a line, without dots and blanks at its end: first is the first match of an amount in it, rest the pattern of that and all that follows.

    A line is plain characters but for odd line breaks, at which patterns end.
    """
    odd = line.rlike("[\r\n\u0085\u2028\u2029]")
    plain = strip(F.rtrim(F.call_function("substring_index", line, first, F.lit(1)), F.lit("." + _WHITE)))
    return F.when(odd, strip(F.regexp_replace(F.regexp_replace(line, rest, ""), r"[.\s]+$", ""))).otherwise(plain)


def dollars(raw: Column, in_thousands: Column) -> Column:
    digits = strip(F.translate(raw, "$,", ""))
    return F.when(digits.rlike(r"^\d+$"), digits.try_cast("bigint") * F.when(in_thousands, 1000).otherwise(1))


def on_page(raw: Column, page: Column) -> Column:
    """The amount is printed on the page, with or without commas; a missing amount is no contradiction."""
    bare = F.translate(raw, "$", "")
    # commas are taken off a page only where the amount isn't on it as it is: as a case, so that this is no expression that two amounts share and evaluate first
    return F.when(raw.isNull() | page.contains(bare), F.lit(True)).otherwise(F.translate(page, ",", "").contains(F.translate(bare, ",", "")))


def typeset_minus(s: Column) -> Column:
    """Look-alikes of a minus sign as minus."""
    return F.translate(s, "¥Ø−", "---")


def trailing_amounts(line: Column) -> Column:
    """The run of amounts that ends a typeset line, as strings."""
    return amounts_of_run(trailing_run(line))


def trailing_run(line: Column) -> Column:
    """The run itself, with the white space around it; '' without one."""
    return F.regexp_extract(line, r"(?:\s+[+-]?[\d,]*\d[\d,]*)+\s*$", 0)


def amounts_of_run(run: Column) -> Column:
    """The amounts of such a run."""
    return F.when(run == "", F.array().cast("array<string>")).otherwise(F.split(strip(run), r"\s+"))


def without_leader(s: Column) -> Column:
    """Without the dots and blanks at the end."""
    return F.rtrim(s, F.lit("." + _WHITE))


# ---- rows ----------------------------------------------------------------------------------------------------------


def _all(*cs: Column) -> Column:
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in cs])


def column_layout(label: Column, pe: Column, be: Column, cr: Column, de: Column, dt: Column) -> Column:
    split = _all(pe, be, cr, de, dt) & (pe != 0) & (be != 0) & (pe + be == cr) & (de == pe) & (dt == be)
    return first_of((strip(F.coalesce(label, F.lit(""))).rlike(r"^\d{1,3}\.?$"), "procurement_qty"), (F.coalesce(split, F.lit(False)), "category_split"), otherwise="standard")


def unverified_category(label: Column, raw: Column, pe: Column, be: Column, cr: Column, de: Column, dt: Column) -> Column:
    split = F.coalesce(_all(pe, be, cr, de, dt) & (pe != 0) & (be != 0) & (pe + be == cr) & (de == pe) & (dt == be), F.lit(False))
    yes = lambda c: F.coalesce(c, F.lit(False))
    present = F.concat(*[F.when(c.isNotNull(), n).otherwise("") for c, n in zip((pe, be, cr, de, dt), "PRCde", strict=True)])
    return first_of(
        (F.coalesce(label, F.lit("")).rlike(r"(?i)advance|available|current year|prior year"), "advance_approp"),
        (is_memo_row(label, raw), "parenthetical_memo"),
        (split, "category_split"),
        (cr.isNull() & yes(de == -pe), "elimination"),
        (yes((pe == be) & (be == cr)), "all_three_equal"),
        (yes(cr == pe), "rec_equals_prior"),
        (yes(cr == be), "rec_equals_request"),
        otherwise=F.concat(F.lit("presence:"), F.when(present == "", "none").otherwise(present)),
    )


def gate_of(verified: Column, stage: Column, chamber: Column, method: Column) -> Column:
    """Which check a verified row passed; an unknown track is an error."""
    return first_of((~F.coalesce(verified, F.lit(False)), "none"), (stage == "enacted", "verbatim_page"), (chamber == "senate", "string_match"), ((chamber == "house") & (method == "llm"), "delta_arithmetic"), (chamber == "house", "verbatim_page"), otherwise=F.raise_error(F.lit("cannot name the check of a verified row")).cast("string"))


# ---- coercions -----------------------------------------------------------------------------------------------------


def to_text(c: Column) -> Column:
    return F.when(~strip(c).isin("", "None"), c)


def to_int(c: Column) -> Column:
    """Text to whole number, half to even; blanks and NaN are null."""
    d = strip(c).try_cast("double")
    # whole numbers directly, as a double has 53 bits only
    return F.coalesce(F.when(strip(c).rlike(r"^[+-]?\d+$"), strip(c).try_cast("bigint")), F.when(~F.isnan(d), F.bround(d, 0).try_cast("bigint")))


def to_float(c: Column) -> Column:
    d = strip(c).try_cast("double")
    return F.when(~F.isnan(d), d)


def to_bool(c: Column) -> Column:
    return F.coalesce(F.lower(strip(c)) == "true", F.lit(False))
