"""One consistent form for texts that look the same.

The form removes invisible characters, turns every kind of blank into a space,
full-width, half-width and ligature forms into plain ones, composes accents,
and writes look-alike Latin, Cyrillic and Greek letters as Latin.  It keeps
case, digits, punctuation, the number of blanks and line breaks, and it keeps
superscripts, fractions and other characters that look different.

Only unstable segments are touched.  A character is unstable if a quick check
can tell that it may change or compose: it is combining or composes with the
character before it, has a canonical decomposition of its own, or is in one of
the mappings.  An unstable segment is a run of such characters with the one
character before it as context; it is decomposed, mapped, composed and spliced
back between the untouched rest.  ASCII texts never leave the JVM.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyrig.session import written

#: Letters drawn alike in Latin, Greek and Cyrillic (Latin; the others).  Small letters that are only
#: loosely alike and whose capitals are not (gamma, sigma, upsilon, Cyrillic ghe) are kept apart.
LOOK_ALIKES = {
    "A": "ΑА", "B": "ΒВ", "C": "СϹ", "E": "ΕЕ", "F": "Ϝ", "G": "Ԍ", "H": "ΗН", "I": "ΙІӀ", "J": "ЈͿ",
    "K": "ΚК", "M": "ΜМϺ", "N": "Ν", "O": "ΟО", "P": "ΡР", "Q": "Ԛ", "S": "Ѕ", "T": "ΤТ",
    "V": "Ѵ", "W": "Ԝ", "X": "ΧХ", "Y": "ΥУҮϒ", "Z": "Ζ",
    "a": "аα", "c": "сϲ", "d": "ԁ", "e": "е", "h": "һ", "i": "іι", "j": "јϳ", "l": "ӏ", "o": "οо",
    "p": "ρр", "q": "ԛ", "s": "ѕ", "v": "νѵ", "w": "ԝ", "x": "х", "y": "уү",
}
#: Ranges that show nothing and are not format characters.
_INVISIBLE = ((0x034F, 0x034F), (0x115F, 0x1160), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFFA0, 0xFFA0), (0xE0100, 0xE01EF))
#: Format characters that do show a mark.
_VISIBLE_FORMAT = ((0x0600, 0x0605), (0x06DD, 0x06DD), (0x070F, 0x070F), (0x0890, 0x0891), (0x08E2, 0x08E2), (0x110BD, 0x110CD))
#: The Latin ligatures.
_LIGATURES = range(0xFB00, 0xFB07)
#: Canonical decompositions and format characters end before this (variation selectors and tags follow in plane 14).
_LAST, _TAGS = 0x30000, range(0xE0000, 0xE0200)


def _within(code: int, ranges: tuple) -> bool:
    return any(a <= code <= z for a, z in ranges)


@lru_cache(maxsize=1)
def _tables() -> tuple[dict, re.Pattern]:
    """The character mapping, and the pattern of a run of unstable characters."""
    mapping: dict[int, str] = {}
    unstable: set[int] = set()
    for code in [*range(0x80, _LAST), *_TAGS]:
        char = chr(code)
        kind = unicodedata.category(char)
        if kind in ("Cn", "Cs", "Co") and not _within(code, _INVISIBLE):
            continue
        parts = unicodedata.decomposition(char)
        if kind == "Cf" and not _within(code, _VISIBLE_FORMAT) or _within(code, _INVISIBLE):
            mapping[code] = ""
        elif kind == "Zs":
            mapping[code] = " "
        elif parts.startswith(("<wide>", "<narrow>")) or code in _LIGATURES:
            mapping[code] = unicodedata.normalize("NFKC", char)
        if unicodedata.combining(char) or not unicodedata.is_normalized("NFC", char):
            unstable.add(code)
        if parts and not parts.startswith("<"):
            # The second part of a composite composes with what comes before it.
            second = parts.split()[1:]
            if second and unicodedata.is_normalized("NFC", char):
                unstable.add(int(second[0], 16))
    unstable |= {*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)}  # Hangul vowels and final consonants
    for latin, others in LOOK_ALIKES.items():
        mapping |= {ord(other): latin for other in others}
    # A composite of a look-alike letter, such as a Cyrillic io, decomposes to it.
    for code in range(0x80, 0x2000):
        first = unicodedata.normalize("NFD", chr(code))
        if len(first) > 1 and ord(first[0]) in mapping:
            unstable.add(code)
    unstable |= mapping.keys()
    # Beyond the basic plane every character counts as unstable: a single range, which the pattern tests fast.
    ordered, spans = sorted(c for c in unstable if 0x80 <= c < 0x10000), []
    for code in ordered:
        if spans and spans[-1][1] == code - 1:
            spans[-1][1] = code
        else:
            spans.append([code, code])
    spans.append([0x10000, 0x10FFFF])
    members = "".join(f"{re.escape(chr(a))}-{re.escape(chr(z))}" for a, z in spans)
    return mapping, re.compile(f"[{members}]+")


def canonical(text: str) -> str:
    """The consistent form of ``text``; applying it twice changes nothing."""
    if text.isascii():
        return text
    mapping, unstable = _tables()
    normalize = unicodedata.normalize
    out, done = [], 0
    for run in unstable.finditer(text):
        start = max(run.start() - 1, done)
        decomposed = normalize("NFD", text[start : run.end()])
        # A full-width form may map to a composite or a combining mark, hence the second decomposition.
        mapped = normalize("NFD", decomposed.translate(mapping)).translate(mapping)
        out += [text[done:start], normalize("NFC", mapped)]
        done = run.end()
    out.append(text[done:])
    return "".join(out)


@F.pandas_udf(StringType())
def _canonical_udf(texts: pd.Series) -> pd.Series:
    return texts.map(canonical, na_action="ignore")


def canonical_text(text: Column) -> Column:
    """``canonical`` as a column; null stays null, '' stays ''."""
    other = F.when(text.rlike(r"[^\x00-\x7F]"), text)
    return F.coalesce(_canonical_udf(other), text)


def canonical_documents(documents: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``id_column, text, canonical`` of every row with an id; null texts have a null form."""
    return documents.select(
        F.col(id_column).alias(id_column), F.col(text).alias("text"), canonical_text(F.col(text)).alias("canonical")
    ).filter(F.col(id_column).isNotNull())


def _digests(documents: DataFrame, text: str, id_column: str) -> DataFrame:
    """``id, form, variant``: 128-bit digests of each document's consistent form and of its text, each once.

    Written, as the forms are the costly part and the digests are read more than once.
    """
    forms = canonical_documents(documents, text, id_column).filter(F.col("text").isNotNull())
    digest = lambda c: F.unhex(F.md5(c))
    return written(
        forms.select(F.col(id_column).alias("id"), digest("canonical").alias("form"), digest("text").alias("variant")).dropDuplicates(["id", "variant"])
    )


def look_alike_pairs(documents: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Pairs of documents whose texts differ but have one consistent form.

    Result: ``<id>_a, <id>_b`` with a < b.  Texts and forms travel as 128-bit
    digests.  First the different texts of a form are paired, each once however
    many copies it has, and then their documents are put in: what is joined in
    the end are the rows of the result, and two copies of one text never meet.
    ``look_alike_classes`` gives the same links without any pair.

    Null texts and null ids are left out; two empty texts are identical and no
    pair; repeated rows of one id and text count once.  An id with two texts
    never pairs with itself.  Empty tables give no rows.
    """
    digests = _digests(documents, text, id_column)
    variants = digests.select("form", "variant").distinct()
    x = variants.select("form", F.col("variant").alias("va"))
    y = variants.select("form", F.col("variant").alias("vb"))
    links = x.join(y, "form").filter("va < vb").select("va", "vb")
    of = lambda name, v: digests.select(F.col("id").alias(name), F.col("variant").alias(v))
    pairs = links.join(of("a", "va"), "va").join(of("b", "vb"), "vb").filter("a <> b")
    return pairs.select(F.least("a", "b").alias(f"{id_column}_a"), F.greatest("a", "b").alias(f"{id_column}_b")).distinct()


def look_alike_classes(documents: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Each document with the class of its consistent form, and how many look-alikes it has.

    Result: ``id_column, class_id, texts, documents, links``: the form's digest,
    how many different texts and how many documents have it, and how many of
    those have another text than this one (zero for mere copies).  No pairs are
    made; counts combine before they are shuffled.

    Null texts and null ids are left out; repeated rows count once; an id with
    several texts has a row for each.  Empty tables give no rows.
    """
    digests = _digests(documents, text, id_column)
    variants = digests.groupBy("form", "variant").agg(F.count(F.lit(1)).alias("own"))
    classes = variants.groupBy("form").agg(F.count(F.lit(1)).alias("texts"), F.sum("own").alias("documents"))
    known = variants.join(classes, "form").select("variant", "form", "texts", "documents", (F.col("documents") - F.col("own")).alias("links"))
    return digests.select("id", "variant").join(known, "variant").select(
        F.col("id").alias(id_column), F.lower(F.hex("form")).alias("class_id"), "texts", "documents", "links"
    )
