"""Text functions: tokens, product descriptions, coded columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from ratesheet import fixed_values as fv

# Whitespace and digits in the Unicode sense, not Java's ASCII default.
WS = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
DIGIT = r"\p{Nd}"
NUMBER = rf"{DIGIT}+(?:\.{DIGIT}+)?"

# Anything that is not printable ASCII. Most texts have none and take the short way.
_UNUSUAL = "[^ -~]"

# One pass over a trimmed text with plain spaces: (1) the words before the first word that
# holds a digit, (2) that word, (3) and (4) the two words after it. Possessive quantifiers
# keep the match linear in the text length.
_PARTS = (
    rf"^((?:[^{DIGIT} ]++ ++)*+)([^{DIGIT} ]*+{DIGIT}[^ ]*+)(?: ++([^ ]++))?(?: ++([^ ]++))?.*$"
)


def spaced(c: Column) -> Column:
    """Every whitespace character turned into a plain space."""
    return F.when(c.rlike(_UNUSUAL), F.regexp_replace(c, f"[{WS}]", " ")).otherwise(c)


def strip(c: Column) -> Column:
    """Remove all leading and trailing whitespace (``trim`` removes spaces only)."""
    every = F.regexp_replace(c, f"^[{WS}]+|[{WS}]+$", "")
    return F.when(c.rlike(_UNUSUAL), every).otherwise(F.trim(c))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def tokens(c: Column) -> Column:
    """Words separated by any run of whitespace; an empty text has none."""
    return F.filter(F.split(spaced(c), " +"), lambda w: w != "")


def strength_number(token: Column) -> Column:
    """First number in a token, as text; null when it holds no digit."""
    return F.when(token.rlike(DIGIT), _first_number(token))


def _first_number(token: Column) -> Column:
    return F.regexp_extract(F.replace(token, F.lit("%"), F.lit("")), f"({NUMBER})", 1)


def cut_description(c: Column) -> Column:
    """A product description cut around its strength word, as an array.

    The strength word is the first word with a digit. The array holds that word, the two
    words after it and the text before it; a text without digits is left whole, in one
    piece. The text holds no line break any more when it is split at one.
    """
    return F.split(F.regexp_replace(F.trim(spaced(c)), _PARTS, "$2\n$3\n$4\n$1"), "\n", 4)


def description_fields(cut: Column, c: Column) -> dict[str, Column]:
    """Name, strength, dosage and form from a cut description.

    ``cut`` should be a materialised column: it is read many times.
    """
    word, following, second, before = (F.get(cut, F.lit(i)) for i in range(4))
    found = word.rlike(DIGIT)
    percent = F.contains(word, F.lit("%"))
    single = F.when(F.contains(before, F.lit("  ")), F.regexp_replace(before, " +", " ")).otherwise(before)
    name = F.when(before != "", F.trim(single)).otherwise(word)
    form = F.when(percent, blank_to_null(following)).otherwise(blank_to_null(second))
    return {
        "drug_name": F.when(found, name).otherwise(blank_to_null(strip(c))),
        "drug_strength": F.when(found, _first_number(word)),
        "drug_dosage": F.when(found, F.when(percent, word).otherwise(blank_to_null(following))),
        "drug_form": F.when(found, form),
    }


def legacy_cut(c: Column) -> Column:
    return F.split(c, " ")


def legacy_fields(words: Column, c: Column) -> dict[str, Column]:
    """The older positional rules: form, dosage and strength are the last three words."""
    n = F.size(words)
    name_words = F.when(n >= 4, n - 3).otherwise(1)
    name = F.when(n >= 2, F.array_join(F.slice(words, F.lit(1), name_words), " ")).otherwise(c)
    number = F.regexp_extract(F.get(words, n - 3), r"^(\d+)", 1)
    return {
        "drug_name": name,
        "drug_strength": F.when(n >= 3, number.try_cast("int")),
        "drug_dosage": F.when(n >= 2, F.get(words, n - 2)),
        "drug_form": F.get(words, n - 1),
    }


def code_list(c: Column) -> Column:
    """Comma-separated codes as an array of stripped, non-blank codes."""
    return F.filter(F.transform(F.split(c, ","), strip), lambda code: code != "")


def lookup(names: dict[str, str]) -> Column:
    """A fixed table of texts as a map literal."""
    return F.create_map(*[F.lit(x) for pair in names.items() for x in pair])


def explain_codes(c: Column) -> Column:
    """Texts of the known codes, in order and with repeats; null when none is known."""
    names = lookup(fv.EXPLANATION_CODES)

    def texts(stripped: Callable[[Column], Column]) -> Column:
        # Joining leaves out what has no text, blank codes among it.
        known = F.transform(F.split(c, ","), lambda code: names[stripped(code)])
        return F.array_join(known, fv.EXPLANATION_SEPARATOR)

    return blank_to_null(F.when(c.rlike(_UNUSUAL), texts(strip)).otherwise(texts(F.trim)))


def _decode(c: Column, names: dict[str, str]) -> Column:
    shown = c
    for code, name in names.items():
        shown = F.when(c == code, F.lit(name)).otherwise(shown)
    return shown


def classification_name(c: Column) -> Column:
    return _decode(c, fv.CLASSIFICATION_NAMES)


def pharmacy_name(c: Column) -> Column:
    return _decode(c, fv.PHARMACY_NAMES)


def otc_name(c: Column) -> Column:
    return F.when(c == "Y", fv.OTC_YES).when(c.isNotNull(), fv.OTC_OTHER)


def money(c: Column) -> Column:
    """A number with two decimals, rounded on its binary value; null kept null."""
    return F.call_function("format_number", c, F.lit("0.00"))


def preview(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)
