"""Text and markup helpers, all evaluated inside the JVM."""

from __future__ import annotations

from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
SITE = "https://nhadat247.com.vn"
LABEL_TAIL = "..."

ENTITY = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"
VOID_TAG = r"(?i)^<(?:area|base|br|col|embed|hr|img|input|link|meta|source|track|wbr)\b|^<[^>]*/>"
# All characters Unicode counts as white space, and the four separators below the blank.
WHITE_SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Stands for a removed tag while entities are decoded; not allowed in HTML text.
TAG_MARK = "\u0001"
# Rounds of a running sum: 2 to this power is more than the tags that a text can hold.
SCAN_ROUNDS = 29
# The HTML 5 names that end in a semicolon with what they stand for, as the text of a map; short names are met most and come first.
ENTRY_MARK, NAME_MARK = "\u0002", "\u0003"
ENTITIES = ENTRY_MARK.join(f"{name[:-1]}{NAME_MARK}{found}" for name, found in sorted(html5.items(), key=lambda e: len(e[0])) if name.endswith(";"))
# Numbers 0x80 to 0x9F mean what Windows-1252 has there, or themselves.
WINDOWS = "".join(bytes([c]).decode("cp1252", "ignore") or chr(c) for c in range(0x80, 0xA0))


def strip(text: Column) -> Column:
    """Remove leading and trailing white space of any kind, not only blanks."""
    return F.trim(text, F.lit(WHITE_SPACE))


def truncate_label(text: Column, size: int) -> Column:
    """First ``size`` characters and dots when the label is longer."""
    return F.when(
        F.length(text) > size, F.concat(F.substring(text, 1, size), F.lit(LABEL_TAIL))
    ).otherwise(text)


def month_day(day: Column) -> Column:
    return F.date_format(day, "MM-dd")


def absolute_url(link: Column, site: str = SITE) -> Column:
    """Absolute form of a link without surrounding white space.

    ``//host/path`` gets a scheme and is tested before ``/path``, which gets the site in
    front.
    """
    return (
        F.when(link.startswith("http"), link)
        .when(link.startswith("//"), F.concat(F.lit("https:"), link))
        .when(link.startswith("/"), F.concat(F.lit(site), link))
        .otherwise(F.concat(F.lit(site + "/"), link))
    )


def normalize_url(url: Column, site: str = SITE) -> Column:
    """Absolute form of a link; the empty string stays empty."""
    return F.when(url == "", url).otherwise(absolute_url(strip(url), site))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, also where the body names it often."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _character(codepoint: Column) -> Column:
    usable = codepoint.between(1, 0xD7FF) | codepoint.between(0xE000, 0x10FFFF)
    safe = F.when(usable, codepoint).otherwise(F.lit(0xFFFD))
    shown = F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32")
    return F.when(codepoint.between(0x80, 0x9F), F.substr(F.lit(WINDOWS), codepoint - 0x7F, F.lit(1))).otherwise(shown)


def _referenced(name: Column) -> Column:
    """What a character reference stands for, NULL for a name that HTML doesn't have."""
    named = F.str_to_map(F.lit(ENTITIES), F.lit(ENTRY_MARK), F.lit(NAME_MARK))
    return (
        F.when(name.rlike("^#[xX]"), let(F.conv(F.substring(name, 3, 6), 16, 10).try_cast("int"), _character))
        .when(name.startswith("#"), let(F.substring(name, 2, 7).try_cast("int"), _character))
        .when(name != "", F.try_element_at(named, name))
    )


def unescape(text: Column) -> Column:
    """Decode character references that end in a semicolon."""

    def decode(piece: Column, position: Column) -> Column:
        found = let(F.regexp_extract(piece, ENTITY, 1), lambda name: F.concat(_referenced(name), F.substr(piece, F.length(name) + 2)))
        return F.when(position == 0, piece).otherwise(F.coalesce(found, F.concat(F.lit("&"), piece)))

    return F.when(~text.contains("&"), text).otherwise(F.array_join(F.transform(F.split(text, "&"), decode), ""))


def text_of(markup: Column) -> Column:
    """Text of a piece of markup: each run between tags stripped, then joined."""
    marked = unescape(F.regexp_replace(markup, r"<[^>]*>", TAG_MARK))
    return strip(F.regexp_replace(marked, rf"(?U)\s*{TAG_MARK}[\s{TAG_MARK}]*", ""))


def raw_text_of(markup: Column) -> Column:
    """Text of a piece of markup with its white space as it is."""
    return unescape(F.regexp_replace(markup, r"<[^>]*>", ""))


def unquote(attribute: Column) -> Column:
    """Value of an attribute as written, with or without quotes."""
    return unescape(F.regexp_replace(attribute, "^[\"']|[\"']$", ""))


def running_sum(values: Column) -> Column:
    """Sums of an array of numbers up to each place, in rounds that add what stands 1, 2, 4, ... places before.

    A round costs the length of the array, and there are as many as its length has binary
    digits; adding up place by place would copy the array each time.
    """
    def added(sums: Column, step: Column) -> Column:
        one = F.transform(sums, lambda x, i: x + F.when(i >= step, F.coalesce(F.get(sums, i - step), F.lit(0))).otherwise(F.lit(0)))
        return F.when(F.size(sums) > step, one).otherwise(sums)

    return F.aggregate(F.array(*[F.lit(1 << k) for k in range(SCAN_ROUNDS)]), values, added)


def elements(markup: Column, tag: str, opening: str) -> Column:
    """All elements of the name whose start tag matches ``opening``, in page order, nested ones too.

    An element ends where its start and end tags balance; if they never do, at the first
    end tag; without one it is left out. NULL where no start tag matches.

    All ends are found at once: tags are sorted by depth and place, and behind a start tag
    stands the end tag that closes it, if there is one. The cost grows with the number of
    tags times its logarithm, and with the length of the elements. Where the next tag of the
    name behind each matching start tag is an end tag, as on most pages, that one balances
    it, and one pattern finds them all. ``opening`` matches one start tag of the name, up to its first ``>``.
    """
    # What holds no tag of the name.
    gap = rf"[^<]*+(?:<(?!/?{tag}\b)[^<]*+)*+"
    # A matching start tag behind which another one or none follows, or a start tag that holds a bracket.
    nested = rf"{opening}{gap}(?:<{tag}\b|\z)|(?i)<{tag}\b[^>]*<"
    plain_ = rf"{opening}{gap}</{tag}\b(?:(?!</?{tag}\b)[^>])*+>?"

    def of_pieces(pieces: Column) -> Column:
        signs = F.transform(
            pieces,
            lambda p: F.when(p.rlike(rf"(?i)^</{tag}\b"), F.lit(-1)).when(p.rlike(rf"(?i)^<{tag}\b"), F.lit(1)).otherwise(F.lit(0)),
        )
        return let(signs, lambda s: let(running_sum(s), lambda depths: of_depths(pieces, s, depths)))

    def of_depths(pieces: Column, signs: Column, depths: Column) -> Column:
        # Only what stands before the first tag is no tag.
        plain = F.when(F.get(signs, F.lit(0)) == 0, F.lit(1)).otherwise(F.lit(0))

        def starts_to(i: Column) -> Column:
            return F.floor((i + 1 - plain + F.get(depths, i)) / 2).cast("int")

        places = F.sequence(F.lit(0), F.size(pieces) - 1)
        tags = F.transform(
            F.filter(places, lambda i: F.get(signs, i) != 0),
            lambda i: F.struct(
                (F.get(depths, i) + F.when(F.get(signs, i) < 0, F.lit(1)).otherwise(F.lit(0))).alias("depth"),
                i.alias("place"),
                (F.get(signs, i) < 0).alias("ends"),
            ),
        )

        def closed(sorted_tags: Column) -> Column:
            def end(tag_: Column, k: Column) -> Column:
                behind = F.get(sorted_tags, k + 1)
                return F.struct(tag_["place"].alias("place"), F.when(behind["ends"] & (behind["depth"] == tag_["depth"]), behind["place"]).alias("end"), tag_["ends"].alias("ends"))

            return F.filter(F.transform(sorted_tags, end), lambda t: ~t["ends"])

        # Start tags in page order, each with the place of its end tag or NULL.
        pairs = F.array_sort(let(F.array_sort(tags), closed))
        ends = F.filter(places, lambda i: F.get(signs, i) < 0)

        def cut(pairs: Column, ends: Column) -> Column:
            def body(i: Column) -> Column:
                balanced = F.get(pairs, starts_to(i) - 1)["end"]
                any_end = F.get(ends, i + 1 - plain - starts_to(i))
                return let(
                    F.coalesce(balanced, any_end),
                    lambda end: F.when(
                        end.isNotNull(),
                        F.concat(F.array_join(F.slice(pieces, i + 1, end - i), ""), F.regexp_extract(F.get(pieces, end), "^[^>]*>?", 0)),
                    ),
                )

            starts = F.filter(places, lambda i: (F.get(signs, i) > 0) & F.get(pieces, i).rlike("^" + opening))
            return F.filter(F.transform(starts, body), lambda e: e.isNotNull())

        return let(pairs, lambda p: let(ends, lambda e: cut(p, e)))

    found = let(F.split(markup, rf"(?i)(?=</?{tag}\b)"), of_pieces)
    every = F.when(markup.rlike(nested), found).otherwise(F.regexp_extract_all(markup, F.lit(plain_), F.lit(0)))
    return F.when(markup.rlike(opening), every)


def around(markup: Column, label: str) -> Column:
    """Text of the innermost element that directly holds the first text with the label, of all if none does; NULL without the label.

    Start and end tags are balanced on both sides of the label, whatever their names.
    """

    def of_pieces(pieces: Column) -> Column:
        signs = F.transform(
            pieces,
            lambda p: F.when(p.startswith("</"), F.lit(-1))
            .when(p.rlike(VOID_TAG) | ~p.rlike("^<[a-zA-Z]"), F.lit(0))
            .otherwise(F.lit(1)),
        )
        holds = F.transform(pieces, lambda p: F.regexp_replace(p, "^<[^>]*>?", "").rlike("(?iU)" + label))

        def steps(wanted: int) -> Callable[[Column, Column], Column]:
            def step(acc: Column, sign: Column) -> Column:
                open_ = acc["open"] + sign
                places = F.when(acc["done"], acc["places"]).otherwise(acc["places"] + 1)
                return F.struct(open_.alias("open"), places.alias("places"), (acc["done"] | (open_ == wanted)).alias("done"))

            return step

        start = F.struct(F.lit(0).alias("open"), F.lit(0).alias("places"), F.lit(False).alias("done"))

        def of_place(place: Column) -> Column:
            def of_signs(signs: Column) -> Column:
                before = F.aggregate(F.reverse(F.slice(signs, 1, place)), start, steps(1), lambda acc: acc["places"])
                after = F.aggregate(
                    F.slice(signs, place + 1, F.size(signs)), start, steps(-1), lambda acc: acc["places"] - acc["done"].cast("int")
                )
                return let(before, lambda n: raw_text_of(F.array_join(F.slice(pieces, place - n + 1, n + after), "")))

            return F.when(place > 0, let(signs, of_signs))

        return let(F.array_position(holds, F.lit(True)).cast("int"), of_place)

    found = let(F.split(markup, "(?=</?[a-zA-Z])"), of_pieces)
    return F.when(markup.rlike("(?iU)" + label), found)
