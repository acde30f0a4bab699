"""Names, addresses, phone numbers and zip codes."""

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word starts at a cased letter that follows anything but a cased letter.
_CASED = r"[\p{IsLowercase}\p{IsUppercase}\p{IsTitlecase}]"
_WORD_START = rf"(?<!{_CASED})(?={_CASED})"


def _title_letters() -> dict[str, str]:
    """The letters whose title case is not their upper case, by the rules of Unicode: digraphs, ligatures,
    the sharp s and some Greek letters."""
    letters = (chr(i) for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000)
    return {c: c.title() for c in letters if c.title() != c.upper()}


_TITLE_LETTERS = _title_letters()


def title_case(text: Column) -> Column:
    """``o'neil mary-ann`` -> ``O'Neil Mary-Ann``: unlike ``initcap``, a letter
    after any non-letter is capitalised, not only one after a space. As Python's ``title``, but for the Greek
    sigma at the end of a word, which each decides by rules of its own."""
    special = F.create_map(*(F.lit(x) for pair in _TITLE_LETTERS.items() for x in pair))

    def capitalised(word: Column) -> Column:
        first = F.substring(word, 1, 1)
        rest = F.lower(word.substr(F.lit(2), F.length(word)))
        return F.concat(F.coalesce(F.element_at(special, first), F.upper(first)), rest)

    return F.array_join(F.transform(F.split(text, _WORD_START), capitalised), "")


def street_address(apartment: Column, street: Column) -> Column:
    """Apartment first; null if either part is missing."""
    return F.concat(apartment, F.lit(" , "), street)


def local_phone(number: Column, area: str = "516") -> Column:
    """``1237818`` -> ``(516)123-7818``; the raw number carries no area code."""
    digits = number.cast("string")
    rest = digits.substr(F.lit(4), F.length(digits))
    return F.concat(F.lit(f"({area})"), F.substring(digits, 1, 3), F.lit("-"), rest)


def full_phone(number: Column) -> Column:
    """``1234565276`` -> ``(123)456-5276``."""
    return F.concat(
        F.lit("("),
        F.substring(number, 1, 3),
        F.lit(")"),
        F.substring(number, 4, 3),
        F.lit("-"),
        F.substring(number, 7, 10),
    )


def zip_number(text: Column) -> Column:
    """Zip text as a number; text that is no whole number gives null."""
    return text.try_cast("int")


def strict_zip_number(text: Column) -> Column:
    """``zip_number``, but fails the job on a zip that is missing or no whole number."""
    message = F.concat(F.lit("not a zip: "), F.coalesce(text, F.lit("missing")))
    return F.coalesce(zip_number(text), F.raise_error(message).cast("int"))


def zip_text(number: Column, default: str = "00000") -> Column:
    """Five characters, ``default`` where the zip is missing. The cast comes
    before the default: as a number, ``00000`` would turn into ``0``. Longer text stays as it is."""
    text = F.trim(number.cast("string"))
    padded = F.when(F.length(text) < 5, F.lpad(text, 5, "0")).otherwise(text)
    return F.coalesce(padded, F.lit(default))
