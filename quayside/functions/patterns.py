"""Personal-data entities.

Every pattern stays in the subset that Java and RE2 read alike: no look-around,
no back-references, no word boundaries.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Entity:
    """A kind of personal data, found by its text or by the column's name.

    ``needs`` is a piece of text every match holds; cells without it skip the pattern.
    ``sign`` is a pattern, cheap to look for, that matches in every text that holds the entity;
    without one it is the entity's own.
    """

    name: str
    category: str
    pattern: str
    by_column_name: bool = False
    luhn: bool = False
    needs: str = ""
    sign: str = ""

    @property
    def tag(self) -> str:
        return f"[{self.name.upper()}]"


# Patterns of the built-in entities.
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_MBI_LETTER = "[AC-HJKMNP-RT-Y]"
_MBI_ANY = "[0-9AC-HJKMNP-RT-Y]"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
CARD = r"[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}|[0-9]+"
CARD_HINT = r"[0-9]{13}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}"
PERSON_NAME_COLUMN = r"^(?:(?:first|last|full|given|family)_?name|(?:[a-z]+_)?name)$"
IPV4 = rf"(?:{_OCTET}\.){{3}}{_OCTET}"
MAC = "[0-9A-Fa-f]{2}(?:[:-][0-9A-Fa-f]{2}){5}"
SSN = "[0-9]{3}-[0-9]{2}-[0-9]{4}"
US_PHONE = r"(?:\+1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
DRIVER_LICENCE = "[A-Z][0-9]{7}(?:[0-9]{5,6})?"
MBI = (
    f"[1-9]{_MBI_LETTER}{_MBI_ANY}[0-9]-?{_MBI_LETTER}{_MBI_ANY}[0-9]-?{_MBI_LETTER}{{2}}[0-9]{{2}}"
)

DIGIT = "[0-9]"
#: Of addresses without a digit.
MAC_SIGN = "[A-Fa-f]{2}[:-][A-Fa-f]{2}[:-]"

# Entities of each detection category.
ENTITIES = (
    Entity("email", "universal", EMAIL, needs="@", sign="@"),
    Entity("card_number", "universal", CARD, luhn=True, sign=DIGIT),
    Entity("person_name", "universal", PERSON_NAME_COLUMN, by_column_name=True),
    Entity("ip_v4", "networking", IPV4, sign=DIGIT),
    Entity("mac_address", "networking", MAC, sign=f"{DIGIT}|{MAC_SIGN}"),
    Entity("us_ssn", "united_states", SSN, sign=DIGIT),
    Entity("us_phone", "united_states", US_PHONE, sign=DIGIT),
    Entity("us_driver_licence", "united_states", DRIVER_LICENCE, sign=DIGIT),
    Entity("medicare_beneficiary", "hippa", MBI, sign=DIGIT),
)
CATEGORIES = "universal,hippa,networking,united_states,custom"
CARD_DIGITS = (13, 16)


def passes_luhn(digits: Column) -> Column:
    """Check digit test of a run of digits."""

    def weigh(digit: Column, at: Column) -> Column:
        value = digit.cast("int") * F.when(at % 2 == 1, 2).otherwise(1)
        return F.when(value > 9, value - 9).otherwise(value)

    weighed = F.transform(F.split(F.reverse(digits), ""), weigh)
    return F.aggregate(weighed, F.lit(0), lambda total, x: total + x) % 10 == 0


def card_numbers(text: Column) -> Column:
    """Runs of 13 to 16 digits, plain or in fours, that pass the Luhn test.

    Cells without a long enough run are told apart by a plain pattern first.
    """
    low, high = CARD_DIGITS
    runs = F.regexp_extract_all(text, F.lit(CARD), F.lit(0))

    def is_card(run: Column) -> Column:
        digits = F.regexp_replace(run, "[ -]", "")
        return F.length(digits).between(low, high) & passes_luhn(digits)

    found = F.filter(runs, is_card)
    return F.when(text.rlike(CARD_HINT), found).otherwise(F.array().cast("array<string>"))


def has_entity(text: Column, entity: Entity) -> Column:
    """True when the text holds the entity; null for null text."""
    if entity.by_column_name:
        raise ValueError(f"{entity.name} is found by column name")
    if entity.luhn:
        return F.size(card_numbers(text)) > 0
    found = text.rlike(entity.pattern)
    return F.contains(text, F.lit(entity.needs)) & found if entity.needs else found


def may_hold(text: Column, entities: Iterable[Entity]) -> Column:
    """False for texts that hold none of the entities, told by two looks at the text however many there are.

    The first look is for a sign, which most texts lack: a digit, an at sign. Only texts with one are
    looked at again, by the patterns of all entities joined into one. Null for null text.
    """
    sought = [entity for entity in entities if not entity.by_column_name]
    if not sought:
        return F.when(text.isNotNull(), False)
    signs = dict.fromkeys(part for e in sought for part in ([e.sign] if e.sign else [f"(?:{e.pattern})"]))
    # A sign that is one of another's alternatives is looked for once.
    plain = [s for s in signs if not any(s != other and s in other.split("|") for other in signs)]
    joined = "|".join(f"(?:{CARD_HINT if e.luhn else e.pattern})" for e in sought)
    return F.when(text.rlike("|".join(plain)), text.rlike(joined)).otherwise(F.when(text.isNotNull(), False))
