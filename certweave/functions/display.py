"""Short display texts for graph nodes.

Fixed values: the patterns and tables in this module are the register's own
abbreviations, wordings and short forms.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from certweave.functions.text import DOTTED_CODE, strip

LEGAL_ABBREVIATION = (
    "(?iU)^(?:"
    "ФГБОУ|ФГАОУ|ФГКОУ|ФГБНУ|ФГАНУ|ФГБУК|ФГАУК"
    "|ГБОУ|ГАОУ|ГКОУ|ГБНУ|ГАПОУ|ГБПОУ|ГКПОУ"
    "|МБОУ|МАОУ|МОУ|МКОУ|МБДОУ|МАДОУ|МКДОУ"
    "|АНО|ЧОУ|НОУ|ЧУ"
    ")\\s+(?:ВО|СПО|ДПО|ВПО|ПО|ООП|ДО)?\\s*"
)
LEGAL_WRAPPER = (
    "(?iU)^(?:федеральное|государственное|муниципальное|частное|автономная некоммерческая|некоммерческое)"
    "\\s+(?:государственное\\s+)?(?:бюджетное|автономное|казённое|казенное|частное)\\s+"
    "(?:профессиональное\\s+|общеобразовательное\\s+|дошкольное\\s+)?(?:образовательное\\s+)?(?:учреждение|организация)"
    "(?:\\s+\\S+\\s+(?:области|края|республики|округа|района|города|муниципального\\s+\\S+))?\\s*"
)
INNERMOST_QUOTES = "«([^«»]+)»"
REGION_SUFFIX = (
    "(?iU)\\s+(?:автономная\\s+)?(?:область|край|автономный\\s+округ|округ|район|республика)(?:\\s*[—–-].*)?$"
)
REGION_PREFIX = "(?iU)^(?:г\\.\\s*|Республика\\s+)"
LEVEL_SHORT = {
    "Дошкольное образование": "ДО",
    "Начальное общее образование": "НОО",
    "Основное общее образование": "ООО",
    "Среднее общее образование": "СОО",
    "Среднее профессиональное образование": "СПО",
    "Высшее образование - бакалавриат": "Бакалавриат",
    "Высшее образование - специалитет": "Специалитет",
    "Высшее образование - магистратура": "Магистратура",
    "Высшее образование - подготовка кадров высшей квалификации": "ПКВК",
    "Дополнительное профессиональное образование": "ДПО",
}
POSTGRADUATE_BY_SEGMENT = {"06": "Аспирантура", "07": "Адъюнктура", "08": "Ординатура", "09": "Ассистентура"}
LEVEL_PREFIX = "(?iU)^Высшее образование\\s*[-–—]\\s*"
LEVEL_SUFFIX = "(?iU)\\s+образование$"
HIGHER_LEVELS = [
    "Высшее образование - бакалавриат",
    "Высшее образование - специалитет",
    "Высшее образование - магистратура",
    "Высшее образование - подготовка кадров высшей квалификации",
]
# pattern, short form, whether the region is appended; the first match decides
CONTROL_ORGANS = [
    ("федеральн\\w*\\s+служб\\w+\\s+по\\s+надзору\\s+в\\s+сфере\\s+образования", "Рособрнадзор", False),
    ("\\bрособрнадзор\\b", "Рособрнадзор", False),
    ("министерство\\s+просвещения", "Минпросвещения", True),
    ("министерство\\s+общего\\s+и\\s+профессионального", "Минобр", True),
    ("министерство\\s+образования", "Минобр", True),
    ("министерство\\s+науки", "Миннауки", True),
    ("департамент\\s+образования", "Деп. образования", True),
    ("комитет\\s+по\\s+образованию", "Комитет образования", True),
    ("управление\\s+образования", "Упр. образования", True),
]
# one alternation: the leftmost place where any of the three readings fits decides
ORGAN_REGION = (
    "(?iU)(?:(?:^|\\s)Республик[иа]\\s+(\\w[\\w\\-]*)$"
    "|(\\w[\\w\\-]*)\\s+(?:автономн(?:ой|ого)\\s+)?"
    "(?:области|края|автономного\\s+округа|округа|района|республики)(?:\\s*[—–\\-].*)?$"
    "|г\\.\\s*(\\w[\\w\\-]*)$)"
)
PRIVATE_FORMS = ["частное", "автономная некоммерческая", "некоммерческое партнёрство"]


def _last_quoted(c: Column) -> Column:
    return F.try_element_at(F.regexp_extract_all(c, F.lit(INNERMOST_QUOTES), F.lit(1)), F.lit(-1))


def _without_outer_quotes(c: Column) -> Column:
    return strip(F.trim(c, F.lit("«»")))


def display_name(full: Column, short: Column) -> Column:
    """Readable name of at most 60 (80) characters, preferring the short name."""
    bare = strip(F.regexp_replace(strip(short), LEGAL_ABBREVIATION, ""))
    from_short = strip(F.coalesce(_last_quoted(bare), _without_outer_quotes(bare)))
    whole = strip(full)
    quoted = strip(_last_quoted(whole))
    unwrapped = _without_outer_quotes(strip(F.regexp_replace(whole, LEGAL_WRAPPER, "")))
    return (
        F.when((from_short != "") & (F.length(from_short) <= 60), from_short)
        .when(F.coalesce(full, F.lit("")) == "", F.nullif(F.substring(strip(short), 1, 60), F.lit("")))
        .when(F.length(quoted).between(3, 80), quoted)
        .when((unwrapped != "") & (unwrapped != whole), F.substring(unwrapped, 1, 80))
        .otherwise(F.substring(whole, 1, 60))
    )


def shorten_region(c: Column) -> Column:
    x = F.regexp_replace(strip(c), REGION_SUFFIX, "")
    x = strip(F.regexp_replace(x, REGION_PREFIX, ""))
    return F.coalesce(F.nullif(x, F.lit("")), c)


def _literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def shorten_level(level: Column, code: Column | None = None) -> Column:
    """Short form of a level; with a programme code the postgraduate kind is named."""
    short = F.try_element_at(_literal_map(LEVEL_SHORT), level)
    known = short
    if code is not None:
        segment = F.when(F.size(F.split(code, "\\.")) == 3, F.split(code, "\\.")[1])
        kind = F.try_element_at(_literal_map(POSTGRADUATE_BY_SEGMENT), segment)
        known = F.when(short == "ПКВК", F.coalesce(kind, short)).otherwise(short)
    no_prefix = strip(F.regexp_replace(level, LEVEL_PREFIX, ""))
    head = F.substring(no_prefix, 1, 20)
    capital = F.concat(F.upper(F.substring(head, 1, 1)), F.lower(F.substring(head, 2, 20)))
    no_suffix = strip(F.regexp_replace(level, LEVEL_SUFFIX, ""))
    return F.when(
        level != "",
        F.when(known.isNotNull(), known)
        .when(no_prefix != level, capital)
        .when(no_suffix != level, F.substring(no_suffix, 1, 20))
        .otherwise(F.substring(level, 1, 20)),
    )


def control_organ_region(c: Column) -> Column:
    part = lambda g: F.nullif(F.regexp_extract(c, ORGAN_REGION, g), F.lit(""))
    return F.coalesce(part(1), part(2), part(3))


def control_organ_short(c: Column) -> Column:
    x = strip(c)
    region = control_organ_region(x)
    out = F.when(F.coalesce(c, F.lit("")) == "", F.lit(None).cast("string"))
    for pattern, name, regional in CONTROL_ORGANS:
        text = F.concat(F.lit(name), F.coalesce(F.concat(F.lit(" "), region), F.lit(""))) if regional else F.lit(name)
        out = out.when(x.rlike("(?iU)" + pattern), text)
    return out.otherwise(F.substring(x, 1, 40))


def founder_key(is_federal: Column, form: Column, region: Column, levels: Column) -> Column:
    """Who founded the organisation, read from form, region and the levels it offers."""
    text = F.lower(F.coalesce(form, F.lit("")))
    place = F.coalesce(F.nullif(region, F.lit("")), F.lit("неизвестный регион"))
    higher = F.coalesce(F.arrays_overlap(levels, F.array(*[F.lit(x) for x in HIGHER_LEVELS])), F.lit(False))
    private = F.lit(False)
    for word in PRIVATE_FORMS:
        private = private | text.contains(word)
    return (
        F.when(F.coalesce(is_federal, F.lit(False)), F.when(higher, "federal:nauka").otherwise("federal:prosv"))
        .when(text.contains("муниципальное"), F.concat(F.lit("municipal:"), place))
        .when(text.contains("государственное"), F.concat(F.lit("regional:"), place))
        .when(private, "private")
        .otherwise("unknown")
    )


def founder_label(key: Column) -> Column:
    return (
        F.when(key == "federal:nauka", "Минобрнауки России")
        .when(key == "federal:prosv", "Минпросвещения России")
        .when(key.startswith("municipal:"), F.concat(F.lit("Муниципальный, "), F.regexp_replace(key, "^municipal:", "")))
        .when(key.startswith("regional:"), F.concat(F.lit("Субъект РФ, "), F.regexp_replace(key, "^regional:", "")))
        .when(key == "private", "Частный учредитель")
        .otherwise("Учредитель неизвестен")
    )


def valid_code(c: Column) -> Column:
    return F.coalesce(c.rlike(DOTTED_CODE), F.lit(False))

