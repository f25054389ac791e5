"""Text normalisation as Column expressions (no Python per row)."""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelhouse import fixed_values as fv

# ASCII word boundary; the regex engine's own \b also counts accented letters as word characters.
_WORD = "[A-Za-z0-9_]"
BOUNDARY = f"(?:(?<={_WORD})(?!{_WORD})|(?<!{_WORD})(?={_WORD}))"
BEFORE_WORD = f"(?<!{_WORD})"
AFTER_WORD = f"(?!{_WORD})"
# White space including the no-break and typographic spaces.
SPACE = r"[\s\p{Z}\ufeff]"
_SPACE_CHARACTERS = " \t\n\x0b\f\r\u00a0\u1680\u2028\u2029\u202f\u205f\u3000\ufeff" + "".join(
    chr(c) for c in range(0x2000, 0x200B)
)

_MARKS = "[\\u0300-\\u036f]"
_MARKS_AND_SPACING_ACCENTS = "[\\^`\\u00a8\\u00af\\u00b4\\u00b7\\u00b8\\u0300-\\u036f]"


def once(c: Column, use: Callable[[Column], Column]) -> Column:
    """`use(c)`, with `c` worked out once however often `use` names it."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def pattern(text: str) -> str:
    """Fill the word edges and the wide white-space class into a stored pattern.

    {L} and {R} are the cheaper forms of {B} next to a pattern that itself starts or ends with
    a word character.
    """
    edges = text.replace("{B}", BOUNDARY).replace("{L}", BEFORE_WORD).replace("{R}", AFTER_WORD)
    return edges.replace(r"\s", SPACE)


def _base_letter_table() -> tuple[str, str]:
    source, target = [], []
    for block in (range(0xC0, 0x250), range(0x1E00, 0x1F00)):
        for code in block:
            base = "".join(
                ch for ch in unicodedata.normalize("NFD", chr(code)) if not unicodedata.combining(ch)
            )
            if len(base) == 1 and base != chr(code):
                source.append(chr(code))
                target.append(base)
    return "".join(source), "".join(target)


def _compatibility_table() -> tuple[str, str]:
    source, target = [], []
    for block in (range(0xA0, 0x100), range(0x2000, 0x2200), range(0x2460, 0x2500), range(0xFF01, 0xFF5F)):
        for code in block:
            plain = unicodedata.normalize("NFKC", chr(code))
            if len(plain) == 1 and plain != chr(code):
                source.append(chr(code))
                target.append(plain)
    return "".join(source), "".join(target)


_ACCENTED, _BASE = _base_letter_table()
_COMPAT, _PLAIN = _compatibility_table()


def strip_marks(c: Column) -> Column:
    """Accented Latin letters to their base letter, combining marks dropped."""
    return F.regexp_replace(F.translate(c, _ACCENTED, _BASE), _MARKS, "")


def strip_diacritics(c: Column) -> Column:
    """As strip_marks, and free-standing accents (^ ` ¨ ¯ ´ · ¸) dropped as well."""
    return F.regexp_replace(F.translate(c, _ACCENTED, _BASE), _MARKS_AND_SPACING_ACCENTS, "")


def trim_space(c: Column) -> Column:
    return F.trim(c, F.lit(_SPACE_CHARACTERS))


def collapse_space(c: Column) -> Column:
    """Every run of white space to one plain space; lone plain spaces are not touched."""
    return F.regexp_replace(c, SPACE + r"{2,}|[\s\p{Z}\ufeff&&[^ ]]", " ")


def name_key(c: Column) -> Column:
    """Theatre-name form: folded, lower case, single spaces."""
    return trim_space(collapse_space(F.lower(strip_diacritics(c))))


def squished(c: Column) -> Column:
    """Folded words separated by single spaces."""
    return F.trim(F.regexp_replace(strip_marks(F.lower(c)), "[^a-z0-9]+", " "))


def title_key(c: Column) -> Column:
    """Strong title form: folded, version words and brackets dropped, one leading article dropped."""
    x = F.regexp_replace(strip_diacritics(c), "(?i)" + pattern(fv.NOISE_TOKENS), " ")
    x = F.regexp_replace(x, fv.BRACKETED, " ")
    x = F.regexp_replace(F.lower(F.regexp_replace(x, "[’']", " ")), "[^a-z0-9]+", " ")
    return F.trim(F.regexp_replace(x, fv.LEADING_ARTICLE, ""))


def flat_title(c: Column) -> Column:
    """title_key without spaces, so cut-off titles still contain each other."""
    return F.replace(title_key(c), F.lit(" "), F.lit(""))


def words(c: Column) -> Column:
    """Non-empty space-separated tokens in order."""
    return F.array_remove(F.split(c, " "), "")


def title_words(c: Column) -> Column:
    return words(title_key(c))


def word_similarity(a: Column, b: Column) -> Column:
    """Shared words over the larger word set; 0 when either side has none."""
    wa, wb = F.array_distinct(title_words(a)), F.array_distinct(title_words(b))
    larger = F.greatest(F.size(wa), F.size(wb))
    shared = F.size(F.array_intersect(wa, wb))
    return F.when((F.size(wa) == 0) | (F.size(wb) == 0), F.lit(0.0)).otherwise(shared / larger)


def decode_entities(c: Column) -> Column:
    for entity, char in fv.ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def plain_text(html: Column) -> Column:
    """Visible text of a page fragment: script and style blocks out, tags to spaces."""
    x = F.regexp_replace(html, r"(?is)<script.*?</script>", " ")
    x = F.regexp_replace(x, r"(?is)<style.*?</style>", " ")
    x = F.regexp_replace(x, "<[^>]+>", " ")
    return decode_entities(trim_space(collapse_space(x)))


def listing_title(c: Column) -> Column:
    """Decoded, straight quotes, folded, lower case, single spaces."""
    x = F.replace(decode_entities(c), F.lit("’"), F.lit("'"))
    return trim_space(collapse_space(F.lower(strip_diacritics(x))))


def base_title(c: Column) -> Column:
    """Head of a title before ':' or '-', without a trailing ellipsis."""
    x = trim_space(F.regexp_replace(decode_entities(c), "[.…]+$", ""))
    x = trim_space(F.lower(strip_diacritics(F.replace(x, F.lit("’"), F.lit("'")))))
    head = F.regexp_extract(x, "^([^:-]{3,})", 1)
    return trim_space(collapse_space(F.when(head != "", head).otherwise(x)))


def long_words(c: Column) -> Column:
    """Distinct space-separated words longer than two letters."""
    return F.array_distinct(F.filter(F.split(c, " "), lambda w: F.length(w) > 2))


def long_word_overlap(a: Column, b: Column) -> Column:
    """Number of distinct words longer than two letters that two strings share."""
    return F.size(F.array_intersect(long_words(a), long_words(b)))


def characters(c: Column) -> Column:
    """The distinct characters of a squished text, a bit each."""
    bits = [F.when(F.contains(c, F.lit(ch)), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, ch in enumerate(" 0123456789abcdefghijklmnopqrstuvwxyz")]
    return functools.reduce(Column.bitwiseOR, bits)


def title_distance(a: Column, b: Column) -> Column:
    """0 equal, 1 one contains the other, else 3 less a third per shared-character share; 4 empty."""
    sa, sb = squished(F.coalesce(a, F.lit(""))), squished(F.coalesce(b, F.lit("")))
    return squished_distance(sa, characters(sa), sb, characters(sb))


def squished_distance(sa: Column, ca: Column, sb: Column, cb: Column) -> Column:
    """title_distance of two titles given their squished forms and distinct characters."""
    smaller = F.greatest(F.lit(1), F.least(F.bit_count(ca), F.bit_count(cb)))
    thirds = F.floor(F.bit_count(ca.bitwiseAND(cb)) * 3 / smaller).cast("int")
    return (
        F.when((sa == "") | (sb == ""), 4)
        .when(sa == sb, 0)
        .when(F.contains(sa, sb) | F.contains(sb, sa), 1)
        .otherwise(3 - F.least(F.lit(3), thirds))
    )


def version_signature(c: Column) -> Column:
    """Sorted '+'-joined version flags found in a raw title, 'default' without any."""
    capitals = F.upper(c)
    flags = F.array(
        *[
            F.when(F.contains(capitals, F.lit(letters)) & F.rlike(c, F.lit("(?i)" + pattern(p))), F.lit(flag))
            for flag, letters, p in fv.VERSION_FLAGS
        ]
    )
    joined = F.array_join(F.array_sort(F.array_compact(flags)), "+")
    return F.when(joined == "", "default").otherwise(joined)


def auditorium_key(c: Column) -> Column:
    x = F.regexp_replace(strip_marks(F.lower(F.coalesce(c, F.lit("")))), pattern(fv.AUDITORIUM_WORDS), "")
    x = F.regexp_replace(x, f"#|{SPACE}+", "")
    return F.regexp_replace(x, "(^|[^0-9])0+([0-9])", "$1$2")


def digits(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", "")


def identity_key(c: Column) -> Column:
    """Key under which two spellings of one title meet: compatibility forms, quotes, accents folded."""
    x = F.regexp_replace(c, "[​-‍﻿]", "")
    x = F.translate(x, _COMPAT, _PLAIN)
    x = F.replace(F.replace(x, F.lit("…"), F.lit("...")), F.lit("™"), F.lit("TM"))
    x = F.translate(x, "“”„‟’‘‛", "\"\"\"\"'''")
    return trim_space(F.lower(collapse_space(strip_marks(x))))


def without_version_markers(c: Column) -> Column:
    x = F.coalesce(c, F.lit(""))
    for p in fv.VERSION_MARKERS:
        x = F.regexp_replace(x, "(?i)" + pattern(p), "")
    return trim_space(x)


def separator_variants(c: Column) -> Column:
    """A title and its spellings with '|', ':', '-' or a space between its parts, without doubles."""
    t = trim_space(F.coalesce(c, F.lit("")))
    forms = [t] + [
        F.regexp_replace(t, f"{SPACE}*{sep}{SPACE}*", to)
        for sep, to in ((r"\|", " : "), (":", " | "), ("[:|]", " - "), ("[:|]", " "))
    ]
    return F.array_distinct(F.array_remove(F.array(*forms), ""))


def _blanked(c: Column, patterns: list[tuple[str, bool]]) -> Column:
    """Every match to a space, then single spaces and no outer ones."""
    for p, cased in patterns:
        c = F.regexp_replace(c, ("" if cased else "(?i)") + pattern(p), " ")
    return trim_space(F.regexp_replace(c, SPACE + "{2,}", " "))


def without_attribute_crumbs(c: Column) -> Column:
    """Attribute-like remains that leak into text taken from markup."""
    return _blanked(c, fv.ATTRIBUTE_CRUMBS)


def without_markup_remains(c: Column) -> Column:
    """Stronger form: bracket tails, dangling quotes, media and style attributes."""
    return without_attribute_crumbs(_blanked(c, fv.MARKUP_REMAINS))


def canonical_href(c: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(c, r"^([^?]*)", 1), "/$", "")


def _capitalised_words(c: Column) -> Column:
    """First ASCII letter of every word upper case, the rest as it is."""
    def capitalised(p: Column) -> Column:
        return F.when(
            F.rlike(p, F.lit("^[a-z]")), F.concat(F.upper(F.left(p, F.lit(1))), F.substr(p, F.lit(2)))
        ).otherwise(p)

    return F.array_join(F.transform(F.split(c, pattern("(?<!^)(?={B})")), capitalised), "")


def slug_title(href: Column, drop_version: bool = False) -> Column:
    """Readable title from the last path step of a film address."""
    slug = F.element_at(F.split(canonical_href(href), "/"), -1)
    if drop_version:
        slug = F.regexp_replace(slug, "(?i)^(.*?)-vf(of)?", "$1")
        return trim_space(_capitalised_words(F.replace(slug, F.lit("-"), F.lit(" "))))
    slug = F.when(slug == "", F.lit("Film")).otherwise(slug)
    return _capitalised_words(F.replace(slug, F.lit("-"), F.lit(" ")))


def base_film_url(href: Column, site: str) -> Column:
    """Absolute film address without its schedule, review or trailer step."""
    absolute = F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(site.rstrip("/")), href))
    path = F.regexp_extract(absolute, "^([^?#]*)", 1)
    rest = F.regexp_extract(absolute, "^[^?#]*(.*)$", 1)
    return F.concat(F.regexp_replace(path, "(?i)/(horaires|critiques|bandes-annonces)/?$", ""), rest)


def url_param(url: Column, name: str) -> Column:
    value = F.regexp_extract(url, f"[?&]{name}=([^&#]*)", 1)
    return F.when(F.rlike(url, F.lit(f"[?&]{name}=")), value)


def with_url_param(url: Column, name: str, value: Column) -> Column:
    """Set one query parameter: replaced in place when present, appended otherwise."""
    fragment = F.regexp_extract(url, "(#.*)$", 1)
    bare = F.regexp_extract(url, "^([^#]*)", 1)
    present = F.rlike(bare, F.lit(f"[?&]{name}="))
    before = F.regexp_extract(bare, f"^(.*?[?&]{name}=)", 1)
    after = F.regexp_extract(bare, f"^.*?[?&]{name}=[^&]*(.*)$", 1)
    joint = F.when(F.contains(bare, F.lit("?")), F.lit("&")).otherwise(F.lit("?"))
    return F.when(value.isNotNull(), F.when(present, F.concat(before, value, after, fragment)).otherwise(
        F.concat(bare, joint, F.lit(f"{name}="), value, fragment)
    ))


def without_blanks(values: Column) -> Column:
    """Trimmed non-empty elements, first of each kept, order preserved."""
    return F.array_distinct(F.filter(F.transform(values, trim_space), lambda v: v != ""))


def title_candidate(c: Column) -> Column:
    """A usable alternate title, or NULL for venue words and unlikely lengths."""
    t = trim_space(collapse_space(c))
    t = F.regexp_replace(t, "(?i)^(de|par) +", "")
    t = trim_space(F.regexp_replace(t, "(?s) +[•|].*$", ""))
    usable = ~F.rlike(t, F.lit("(?iu)" + fv.VENUE_OR_FORMAT_WORDS)) & F.length(t).between(2, 120)
    return F.when(usable, t)


def names_no_venue(c: Column) -> Column:
    return ~F.rlike(c, F.lit("(?iu)" + fv.VENUE_WORDS))


def chain_and_screens(subtitle: Column) -> tuple[Column, Column]:
    """Chain name before the bullet and the number of screens, from a theatre subtitle."""
    mentions = F.rlike(subtitle, F.lit("(?i)salle"))
    chain = trim_space(F.element_at(F.split(subtitle, "•"), 1))
    count = F.regexp_extract(subtitle, f"(?i)([0-9]+){SPACE}+salle", 1)
    return (
        F.when(mentions, once(chain, lambda c: F.when(c != "", c))),
        F.when(mentions, once(count, lambda c: F.when(c != "", c.try_cast("int")))),
    )
