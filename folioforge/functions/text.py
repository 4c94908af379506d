"""Text functions as column expressions: normal forms, headword grammar, markers, flags."""

from __future__ import annotations

import unicodedata
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The grammar of headwords, references, markers and stamps.
CAPS = "A-ZÀ-Þ"
HEAD = rf"^([{CAPS}][{CAPS}0-9 .'’\-]*?(?: \([^)]*\))?)\s*([,.])\s+(.+)$"
HEAD_START = rf"^[{CAPS}][{CAPS}0-9 .,'’\-\s]"  # the first two letters of all that HEAD matches
STANDALONE = rf"^([{CAPS}][{CAPS}0-9 .'’\-]*?(?: \([^)]*\))?)[,.]?$"
SEE = rf"\bSee\s+(?:also\s+)?([{CAPS}][A-Za-zÀ-ÿ .'()\-,&]*?)\.?\s*$"
SEE_START = rf"^\s*(?:or [^.]+\.\s*)?See\s+[{CAPS}]"
ALSO = r"(?i)—\s*Also\b"
TABLE_PROMISE = r"(?i)\b(?:following|subjoined|annexed|above|below)\s+table\b|\btable\s+(?:exhibits|shows|gives|of the)\b"
PAGE_MARK = r"^## p\. (\S+) \(#(\d+)\)"
STAMP = r"(?i)digiti[sz]ed by go\w+|^goo\w+$|original from|(?:uni)?versity of min\w*|^y? ?of minnesot\w*|received on board|homeward voyage|^(?:orders|landed|sailed)[.,]?$"
COLOPHON = r"(?i)fullarton|gazetteer of the world|dictionary of geograph|newgate street|eustace street|leith walk|stead.?s place|\bprinters\b"
# What each match of STAMP or COLOPHON has, in small letters, at the start of the text or anywhere.
MARK_STARTS = ("goo", "orders", "landed", "sailed")
MARK_WORDS = ("digiti", "original from", "versity of min", "of minnesot", "received on board", "homeward voyage", "fullarton", "gazetteer of the world", "dictionary of geograph", "newgate street", "eustace street", "leith walk", "s place", "printers")
INLINE_HEAD = rf"(?<=[a-zà-ÿ] )[{CAPS}]{{3,}}[{CAPS} '’\-]*\.\s+(?=[a-zà-ÿ])"
COMPASS = ("N", "S", "E", "W", "NE", "NW", "SE", "SW", "NNE", "NNW", "SSE", "SSW", "ENE", "ESE", "WNW", "WSW")
COLUMN_WORDS = ("VALUE", "VALUES", "IMPORTS", "EXPORTS", "TOTAL", "TOTALS", "AMOUNT", "AMOUNTS", "QUANTITY", "QUANTITIES", "NUMBER", "NUMBERS", "REVENUE", "EXPENDITURE", "POPULATION", "TONS", "ARTICLES", "COMMODITIES", "DESCRIPTION")
NUMERAL = r"^M{0,4}(?:CM|CD|D?C{0,3})(?:XC|XL|L?X{0,3})(?:IX|IV|V?I{0,3})$"
PARTICLES = ("de", "des", "du", "d", "da", "das", "do", "dos", "del", "della", "delle", "dei", "degli", "di", "la", "le", "les", "l", "el", "lo", "los", "las", "van", "von", "der", "den", "ten", "ter", "het", "op", "aan", "am", "an", "im", "in", "ob", "zu", "zur", "zum", "auf", "of", "on", "upon", "the", "and", "by", "sur", "sous", "y", "e", "au", "aux", "a", "à", "lès")


def letters_only(x: Column) -> Column:
    """Upper case, A to Z only; accented letters are dropped, not folded."""
    return F.regexp_replace(F.upper(F.coalesce(x, F.lit(""))), "[^A-Z]", "")


def squeeze(x: Column) -> Column:
    """Lower case, runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), r"\s+", " "))


def word_letters(x: Column) -> Column:
    """Lower case, letters and digits of any script only (accents kept)."""
    return F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), r"[^\p{L}\p{N}]", "")


def _fold_table() -> tuple[str, str]:
    """Latin letters with marks, and the plain letters they decompose to: derived from the Unicode data."""
    pairs = [(chr(c), d[0]) for c in range(0xC0, 0x250) if (d := unicodedata.normalize("NFKD", chr(c))) and d[0].isascii() and d[0].isalpha() and all(unicodedata.combining(x) for x in d[1:]) and len(d) > 1]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def unaccent(x: Column) -> Column:
    """Marks taken off Latin letters; loose combining marks dropped."""
    return F.translate(F.regexp_replace(x, r"\p{M}", ""), *_fold_table())


def fold(x: Column, keep: str = "") -> Column:
    """Unaccented lower-case a-z; ``keep`` adds further characters of a regex class, such as 0-9 or blanks and parentheses."""
    return F.regexp_replace(F.lower(unaccent(F.coalesce(x, F.lit("")))), f"[^a-z{keep}]", "")


def is_false_headword(x: Column) -> Column:
    """Compass points, column words, numerals, numbered sections, runs of one letter."""
    key = letters_only(x)
    first = F.regexp_extract(x, rf"^([IVXLCDM]+|\d{{1,3}})\.?\s+[{CAPS}]", 1)
    numbered = (first != "") & (first.rlike(r"^\d+$") | first.rlike(NUMERAL))
    return key.isin(*COMPASS, *COLUMN_WORDS) | key.rlike("^[IVXLCDM]+$") | x.rlike(r"^(?:[IVXLCDM]{1,5}|\d{1,3})\.\s") | x.rlike(r"(.)\1{7,}") | numbered


def may_be_marked(x: Column) -> Column:
    """Whether a text has words without which neither STAMP nor COLOPHON matches: far cheaper than these, which few texts then need. The text
    is put in small letters once, as the one item of an array."""
    has = lambda low: reduce(or_, [*(F.startswith(low, F.lit(w)) for w in MARK_STARTS), *(F.contains(low, F.lit(w)) for w in MARK_WORDS)])
    return F.exists(F.array(F.lower(x)), has)


def is_stamp(x: Column) -> Column:
    return may_be_marked(x) & x.rlike(STAMP)


def is_mark(x: Column) -> Column:
    """Whether a line holds a stamp or a colophon."""
    return may_be_marked(x) & (x.rlike(STAMP) | x.rlike(COLOPHON))


def is_number(line: Column) -> Column:
    """Whether a line is one to four digits (and perhaps a line end); long lines are not read."""
    return (F.length(line) <= 6) & line.rlike(r"^\d{1,4}$")


def classify_line(line: Column) -> Column:
    """struct<headword, delim, rest, kind> of a line that starts an entry or a reference; null of others. Only lines whose first two letters
    can start a headword are read whole."""
    head, delim, rest = (F.regexp_extract(line, HEAD, k) for k in (1, 2, 3))
    head, body = F.trim(head), F.ltrim(rest)
    named = (head != "") & head.rlike(f"[{CAPS}]{{2}}") & (F.length(F.regexp_replace(head, r"[^\p{L}]", "")) >= 3) & ~is_false_headword(head)
    tail = F.regexp_replace(body, r"[ .]+$", "")
    bare = tail.rlike(f"[{CAPS}]{{2}}") & ~tail.rlike("[a-zà-ÿ]") & (F.length(F.regexp_replace(tail, r"[^\p{L}]", "")) >= 3)
    kind = F.when(body.rlike(SEE_START), "crossref").when((delim == ".") & bare, "crossref").when((delim == ",") & body.rlike(r"^\p{Ll}"), "entry")
    return F.when(line.substr(1, 2).rlike(HEAD_START) & named & kind.isNotNull(), F.struct(head.alias("headword"), delim.alias("delim"), rest.alias("rest"), kind.alias("kind")))


def see_target(x: Column) -> Column:
    return F.nullif(F.trim(F.regexp_extract(x, SEE, 1)), F.lit(""))


def scrub(x: Column) -> Column:
    """Runs of a repeated letter, corrupt dates, stamps, colophons and running heads within a sentence taken out."""
    x = F.regexp_replace(F.regexp_replace(x, r"(.)\1{7,}", "$1"), r"(?:[-–]\d{1,4}){3,}", "")
    unmarked = lambda v: F.when(may_be_marked(v), F.regexp_replace(F.regexp_replace(v, STAMP, ""), COLOPHON, "")).otherwise(v)
    x = F.get(F.transform(F.array(x), unmarked), F.lit(0))
    return F.trim(F.regexp_replace(F.regexp_replace(x, INLINE_HEAD, ""), r"\s{2,}", " "))


def strip_parenthetical(x: Column) -> Column:
    return F.regexp_replace(x, r"\s*\([^)]*\)", "")


def distinct_names(names: Column) -> Column:
    """The first of names that differ only in case and blanks, in order."""
    keys = F.transform(names, squeeze)
    first = F.filter(F.transform(names, lambda x, i: F.struct(x.alias("x"), (F.array_position(keys, F.get(keys, i)) == i + 1).alias("keep"))), lambda s: s["keep"])
    return F.transform(first, lambda s: s["x"])


def title_name(x: Column) -> Column:
    """Readable capitals for a name in upper case: particles after the first word stay low; parts of hyphenated and elided words count."""
    low = F.array(*map(F.lit, PARTICLES))

    def part(p: Column) -> Column:
        at = F.instr(p, "'")
        whole = F.concat(F.upper(p.substr(1, 1)), F.lower(p.substr(F.lit(2), F.length(p))))
        before, after = p.substr(F.lit(1), at - 1), p.substr(at + 1, F.length(p))
        cap = lambda y: F.concat(F.upper(y.substr(1, 1)), F.lower(y.substr(F.lit(2), F.length(y))))
        return F.when(at > 0, F.concat(cap(before), F.lit("'"), cap(after))).otherwise(whole)

    def word(w: Column, i: Column) -> Column:
        parts = F.transform(F.split(w, "-"), lambda c, j: F.when(((i > 0) | (j > 0)) & F.array_contains(low, F.lower(c)), F.lower(c)).otherwise(part(c)))
        return F.array_join(parts, "-")

    return F.array_join(F.transform(F.split(F.trim(x), r"\s+"), word), " ")


def page_mark(line: Column) -> Column:
    """struct<printed int, idx int>, null where the line is no page mark; a printed page that is no number is null."""
    idx = F.regexp_extract(line, PAGE_MARK, 2)
    return F.when(F.startswith(line, F.lit("## p. ")) & (idx != ""), F.struct(F.regexp_extract(line, PAGE_MARK, 1).try_cast("int").alias("printed"), idx.cast("int").alias("idx")))


def volume_tag(name: Column) -> Column:
    """v1 to v99 from a file name such as vol-03.txt or volume_3; otherwise the name without its suffix."""
    number = F.regexp_extract(F.lower(name), r"(?:^|[^a-z])v(?:ol(?:ume)?)?[ ._-]*0*(\d{1,2})(?:\D|$)", 1)
    return F.when(number != "", F.concat(F.lit("v"), number)).otherwise(F.regexp_replace(name, r"\.[^.]*$", ""))


def box_marks(text: Column) -> Column:
    """All boxes of table annotations, as arrays of four integers."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"<!-- table bbox=(\[[^\]]*\]) -->"), 1), lambda b: F.from_json(b, "array<int>"))


def trim_sentence(x: Column, most: int) -> Column:
    """At most ``most`` characters, back to the last sentence end there if it lies in the later half."""
    head = x.substr(1, most)
    cut = F.regexp_extract(head, r"^([\s\S]*[.!?])\s", 1)
    return F.when(F.length(x) <= most, x).when(F.length(cut) >= most / 2, cut).otherwise(F.concat(head, F.lit("…")))


def truncate_marked(x: Column, most: int = 6000) -> Column:
    return F.when(F.length(x) > most, F.concat(x.substr(1, most), F.lit("\n[... truncated ...]"))).otherwise(x)


def script_of(x: Column) -> Column:
    """Script of the first letter that is not Latin; Latin if there is none."""
    scripts = {"Han": "IsHan", "Kana": "IsHiragana", "Katakana": "IsKatakana", "Hangul": "IsHangul", "Cyrillic": "IsCyrillic", "Arabic": "IsArabic", "Greek": "IsGreek", "Hebrew": "IsHebrew", "Devanagari": "IsDevanagari", "Thai": "IsThai"}
    letter = F.regexp_extract(x, r"([\p{L}&&[^\p{IsLatin}]])", 1)
    out = F.lit("Other")
    for name, cls in scripts.items():
        out = F.when(letter.rlike(rf"\p{{{cls}}}"), name).otherwise(out)
    return F.when(letter == "", "Latin").otherwise(out)


def needs_retokenising(name: Column) -> Column:
    """Why a name is treated differently by a tokeniser that drops blanks, marks or scripts; null if it isn't."""
    marks = F.length(F.regexp_replace(name, r"[\p{L}\p{N}\s]", ""))
    return F.when(name.rlike(r"\s"), "space").when(name.rlike(r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}]"), "cjk").when(name.rlike(r"\p{M}"), "not_nfc").when(marks * 4 > F.length(name), "punctuation")


def heading_keys(x: Column) -> Column:
    """Keys under which headings are compared: variants split on 'or' and ';', letters only, tokens of each in order."""
    variants = F.split(F.upper(x), r"\s+OR\s+|;")
    key = lambda v: F.array_join(F.array_sort(F.filter(F.split(F.regexp_replace(v, "[^A-Z ]", " "), " +"), lambda t: t != "")), " ")
    return F.array_distinct(F.filter(F.transform(variants, key), lambda k: k != ""))


def tokens(x: Column) -> Column:
    return F.filter(F.split(F.lower(x), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def natural_key(x: Column) -> Column:
    """Order in which runs of digits count as numbers (up to 12 digits)."""
    return F.array_join(F.transform(F.regexp_extract_all(F.lower(x), F.lit(r"(\d+|\D+)"), 1), lambda t: F.when(t.rlike(r"^\d"), F.lpad(t, 12, "0")).otherwise(t)), "")


def stable_key(*columns: Column, length: int = 64) -> Column:
    """Start of the SHA-256 of the values, joined by a zero character; a null counts as empty."""
    joined = F.concat_ws("\x00", *(F.coalesce(c.cast("string"), F.lit("")) for c in columns))
    return F.sha2(joined.cast("binary"), 256).substr(1, length)
