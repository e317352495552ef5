"""Script profiles: which characters belong, which are variants, and how words are read.

A profile holds plain strings and maps, so that every test becomes a built-in
expression (``translate``, ``rlike``, map lookup) inside generated code.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Profile:
    """Character tables of a script.

    ``variants`` and ``plains`` are aligned: the i-th variant folds to the i-th
    plain character.  ``allowed`` lists the characters that are no garbage
    besides the variants.  ``floor`` is the least code point that is judged at
    all.  ``keep`` lists words that are left alone by folding.
    """

    name: str
    word: str
    max_length: int
    variants: str
    plains: str
    allowed: str
    floor: int = 0
    readings: dict[str, str] = field(default_factory=dict)
    keep: tuple[str, ...] = ()
    #: Variants that a plain table may have all the same.
    exempt: str = ""

    def suspects(self, exempt: str | None = None) -> str:
        """Variants that a plain table should not have."""
        spared = self.exempt if exempt is None else exempt
        return "".join(v for v, p in zip(self.variants, self.plains, strict=True) if v != p and v not in spared and v not in self.keep)

    def pattern(self, max_length: int | None = None) -> str:
        """Words of this script, of 1 to ``max_length`` characters."""
        return f"^[{self.word}]{{1,{max_length or self.max_length}}}$"


#: Letters with marks, and the letters they fold to.
LATIN = Profile(
    name="latin",
    word="a-zß-öø-ÿ",
    max_length=6,
    variants="àáâäãèéêëìíîïòóôöõùúûüñçÿ",
    plains="aaaaaeeeeiiiiooooouuuuncy",
    allowed="abcdefghijklmnopqrstuvwxyz",
)


def is_word(word: Column, profile: Profile, max_length: int | None = None) -> Column:
    """Made of the script's characters only, within the length."""
    return word.rlike(profile.pattern(max_length))


def fold(word: Column, profile: Profile) -> Column:
    """The word with every variant replaced by its plain character."""
    folded = F.translate(word, profile.variants, profile.plains)
    return F.when(word.isin(*profile.keep), word).otherwise(folded) if profile.keep else folded


def is_variant(word: Column, profile: Profile) -> Column:
    """Some character is a variant, and folding changes the word."""
    return fold(word, profile) != word


def is_garbage(word: Column, profile: Profile) -> Column:
    """Some character at or above the floor is in no table."""
    rest = F.translate(word, profile.allowed + profile.variants, "")
    if profile.floor:
        rest = F.regexp_replace(rest, f"[^\\x{{{profile.floor:x}}}-\\x{{10ffff}}]", "")
    return rest != ""


def script_class(word: Column, profile: Profile) -> Column:
    """``garbage``, ``variant`` or ``plain``; the three are disjoint and cover all words."""
    return F.when(is_garbage(word, profile), "garbage").when(is_variant(word, profile), "variant").otherwise("plain")


def reading(word: Column, profile: Profile) -> Column:
    """Readings of all characters joined; null where one has none.

    A profile without a table reads a word as its folded form.
    """
    if not profile.readings:
        return fold(word, profile)
    table = F.create_map(*[F.lit(x) for pair in profile.readings.items() for x in pair])
    parts = F.transform(F.split(word, ""), lambda c: F.try_element_at(table, c))
    return F.when(~F.exists(parts, lambda p: p.isNull()), F.array_join(parts, ""))


def is_reading(r: Column) -> Column:
    """Strict test: ASCII, with a letter, and no capital."""
    return r.rlike(r"^[\x00-\x7F]+$") & r.rlike("[a-z]") & ~r.rlike("[A-Z]")


def is_domain_reading(r: Column) -> Column:
    """Loose test of domain files: not empty, ASCII; it is lower-cased afterwards."""
    return r.rlike(r"^[\x00-\x7F]+$")


def han_profile(spark, start: int = 0x4E00, end: int = 0x9FFF) -> Profile:
    """Han profile, built on the driver from the ICU rules that ship with Spark.

    Characters are converted one by one.  Allowed are those that conversion
    knows in either direction and those of the GB 2312 set; variants of that
    set are exempt from the test of plain tables.  Words of the
    exception list keep their form.  Needs a classic (JVM) session.
    """
    icu = spark.sparkContext._jvm.com.ibm.icu.text.Transliterator
    text = "\n".join(map(chr, range(start, end + 1)))

    def run(rule: str) -> list[str]:
        return icu.getInstance(rule).transliterate(text).split("\n")

    chars, simple, complex_ = text.split("\n"), run("Traditional-Simplified"), run("Simplified-Traditional")
    spoken = run("Han-Latin")
    marks = icu.getInstance("NFD; [\\u0300-\\u0307\\u0309-\\u036F] Remove; NFC").transliterate("\n".join(spoken)).split("\n")
    readings = {c: r.replace("ü", "v").lower() for c, r in zip(chars, marks, strict=True) if r != c and r.isascii() | ("ü" in r)}

    def national(c: str) -> bool:
        try:
            c.encode("gb2312")
        except UnicodeEncodeError:
            return False
        return True

    pairs = [(c, s) for c, s in zip(chars, simple, strict=True) if s != c and len(s) == 1]
    allowed = "".join(c for c, s, t in zip(chars, simple, complex_, strict=True) if s == c and (t != c or national(c)))
    exempt = "".join(c for c, _ in pairs if national(c))
    return Profile("han", "一-鿿", 6, "".join(c for c, _ in pairs), "".join(s for _, s in pairs), allowed, start, readings, ("乾坤",), exempt)
