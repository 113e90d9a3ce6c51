"""Organisation names: typography, legal form, title case, fingerprint.

Word-level rules run as higher-order functions over the words of a name.
``let`` names an intermediate text so that it is worked out once per row. Run
these rules on distinct names and join back (see ``operators.names``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from certweave.functions.nested import let
from certweave.functions.text import WHITE_SPACE, collapse, is_blank, strip

# Legal forms as the register writes them.
FORM_ABBREVIATIONS = [
    "ФГБНИУ", "ФГБОУ ВО", "ФГАОУ ВО", "ФГКОУ ВО", "ФГБОУ", "ФГАОУ", "ФГКОУ", "ГБПОУ", "ГБОУ", "ГАОУ", "ГКОУ", "ГПОУ", "ГОУ",
    "МБОУ", "МОБУ", "МКОУ", "МАОУ", "МОУ", "ЧОУ", "НОУ", "ОГБОУ", "ОГАУ", "ОУ", "АНОО", "МАУ",
]
FORM_NAMES = [
    "Муниципальное казённое общеобразовательное учреждение",
    "Муниципальное бюджетное общеобразовательное учреждение",
    "Муниципальное автономное общеобразовательное учреждение",
    "Муниципальное общеобразовательное учреждение",
    "Государственное бюджетное общеобразовательное учреждение",
    "Государственное автономное общеобразовательное учреждение",
    "Государственное общеобразовательное учреждение",
    "Федеральное государственное казенное военное образовательное учреждение высшего образования",
    "Федеральное государственное бюджетное военное образовательное учреждение высшего образования",
    "Федеральное государственное бюджетное образовательное учреждение высшего образования",
    "Федеральное государственное автономное образовательное учреждение высшего образования",
    "Федеральное государственное казенное образовательное учреждение высшего образования",
    "Федеральное государственное казённое образовательное учреждение высшего образования",
    "Федеральное казенное образовательное учреждение высшего образования",
    "Федеральное государственное бюджетное профессиональное образовательное учреждение",
    "Федеральное государственное бюджетное научное учреждение",
    "Федеральное государственное бюджетное учреждение науки",
    "Федеральное государственное бюджетное учреждение профессиональная образовательная организация",
    "Федеральное государственное казенное общеобразовательное учреждение",
    "Федеральное государственное казённое общеобразовательное учреждение",
    "Федеральное государственное бюджетное образовательное учреждение",
    "Федеральное государственное автономное образовательное учреждение",
    "Федеральное государственное бюджетное учреждение",
    "Федеральное государственное образовательное учреждение",
    "Федеральное казенное профессиональное образовательное учреждение",
    "Федеральное казенное общеобразовательное учреждение",
    "Федеральное бюджетное учреждение науки",
    "Федеральное государственное унитарное предприятие",
    "Частное общеобразовательное учреждение",
    "Негосударственное образовательное учреждение",
    "Автономная некоммерческая образовательная организация высшего образования",
    "Автономная некоммерческая организация",
]
# Words that stay small inside a name.
SMALL_WORDS = [
    "и", "да", "нет", "или", "ли", "же", "бы", "как", "ни", "а", "но", "в", "во", "на", "с", "со", "к", "ко", "у", "о", "об",
    "от", "до", "по", "при", "про", "из", "за", "без", "для", "над", "под", "перед", "через", "между", "им", "им.", "имени", "вв",
]
# Patterns of the name rules.
SHORT_CAPS = 5
TAIL_START = "(?iU)\\s+(?:филиал\\b|структурн\\w*\\s+подразделен\\w*|представительств\\w*|обособленн\\w+\\s+подразделен\\w*)"
NAME_HINT = (
    "(?iU)(?:^|\\s)(?:сош|средн\\w+\\s+общеобразовательн\\w+\\s+школ\\w*|школ\\w*|лице\\w*|гимнази\\w*|колледж\\w*|"
    "техникум\\w*|училищ\\w*|детск\\w+\\s+сад\\w*|апк|по\\b)"
)
QUOTED_NAME = "(?sU)^(.*?)\\s*\"([^\"]*)\"\\s*(.*)$"
TWO_INITIALS = "(?U)([А-ЯЁA-Za-z])\\s*\\.\\s*([А-ЯЁA-Za-z])\\s*\\."
INITIALS_THEN_NAME = "([А-ЯЁA-Z]\\.[А-ЯЁA-Z]\\.)(?=(?:[А-ЯЁA-Z][а-яё]{2,}|[А-ЯЁA-Z]{4,}))"
INITIALISM = "^(?:[А-ЯЁA-Za-z]\\.){2,}$"
INITIALS_CORE = "^(?:[А-ЯЁA-Z]\\.){1,}[А-ЯЁA-Z]?\\.?$"
ROMAN_NUMERAL = "(?i)^[IVXLCDM]{1,8}$"
NUMBER_SIGN = "(?U)№\\s*(\\d)"
NUMBERED = "(?U)№+\\s*\\d+"
MASKED_NUMBER = "№ ⟨N⟩"
WORD_PARTS = "(?s)^([^\\p{L}]*)(.*?)([^\\p{L}]*)$"


def quotes_to_ascii(c: Column) -> Column:
    return F.translate(c, "\u201c\u201d\u201e\u00ab\u00bb\u2018\u2019", "\"\"\"\"\"''")


def trim_in_quotes(c: Column) -> Column:
    return F.regexp_replace(c, "(?U)\"\\s*([^\"]*?)\\s*\"", "\"$1\"")


def strip_double_quotes(c: Column) -> Column:
    """Unwrap ``""x""`` until nothing changes, then delete the quote runs that are left.

    A pass that changes something takes away at least four quotes, so a quarter
    of the quotes is enough passes; once a pass changes nothing the rest are free.
    """
    def state(text: Column, stable: Column) -> Column:
        return F.struct(text.alias("text"), stable.alias("stable"))

    def one_pass(acc: Column, _: Column) -> Column:
        unwrap = F.regexp_replace(acc["text"], "\"\"([^\"]*?)\"\"", "$1")
        return F.when(acc["stable"], acc).otherwise(let(unwrap, lambda new: state(new, new == acc["text"])))

    def unwrap_all(x: Column) -> Column:
        quotes = F.length(x) - F.length(F.replace(x, F.lit('"'), F.lit("")))
        passes = let(quotes, lambda q: F.when(q >= 4, F.sequence(F.lit(1), F.floor(q / 4).cast("int"))).otherwise(F.array().cast("array<int>")))
        unwrapped = F.aggregate(passes, state(x, F.lit(False)), one_pass, lambda acc: acc["text"])
        return F.when(x.contains('""'), F.regexp_replace(unwrapped, "\"\"+", "")).otherwise(x)

    return let(c, unwrap_all)


def dashes_to_hyphen(c: Column) -> Column:
    return F.translate(c, "\u2013\u2014", "--")


def number_sign_spacing(c: Column, space_after: bool = True) -> Column:
    return F.regexp_replace(c, NUMBER_SIGN, "№ $1" if space_after else "№$1")


def typography(c: Column) -> Column:
    """Quotes, dashes, number signs and spaces in one form."""
    x = strip_double_quotes(trim_in_quotes(quotes_to_ascii(strip(c))))
    return collapse(number_sign_spacing(dashes_to_hyphen(x)))


def mask_numbers(c: Column) -> Column:
    """Every number behind a number sign replaced by one mark; blank texts stay as they are."""
    return F.when(is_blank(c), c).otherwise(collapse(F.regexp_replace(collapse(c), NUMBERED, MASKED_NUMBER)))


def initials_spacing(c: Column) -> Column:
    x = F.regexp_replace(collapse(c), TWO_INITIALS, "$1.$2.")
    return collapse(F.regexp_replace(x, INITIALS_THEN_NAME, "$1 "))


def capitalize_first_letter(c: Column) -> Column:
    pattern = "(?s)^([^\\p{L}]*)(\\p{L})(.*)$"
    part = lambda g: F.regexp_extract(c, pattern, g)
    return F.when(c.rlike(pattern), F.concat(part(1), F.upper(part(2)), part(3))).otherwise(c)


def _is_upper(c: Column) -> Column:
    return (c == F.upper(c)) & (c != F.lower(c))


def _core(word: Column) -> Column:
    return F.regexp_extract(word, WORD_PARTS, 2)


def caps_kind(c: Column) -> Column:
    """``all`` / ``mixed`` / ``none``: how much of a name is written in capitals."""
    def decide(cores: Column, initials: Column) -> Column:
        every = F.forall(cores, _is_upper)
        long_one = F.exists(cores, lambda w: _is_upper(w) & (F.length(w) >= SHORT_CAPS))
        lone = (F.size(cores) == 1) & (initials >= 1) & every & F.exists(cores, lambda w: F.length(w) > SHORT_CAPS)
        return (
            F.when(F.exists(cores, lambda w: ~w.rlike("^\\p{L}+$")), "none")
            .when((F.size(cores) >= 2) & every, "all")
            .when((F.size(cores) >= 2) & long_one, "mixed")
            .when(lone, "all")
            .otherwise("none")
        )

    def from_words(words: Column) -> Column:
        initials = F.size(F.filter(words, lambda w: w.rlike(INITIALISM)))
        cores = F.transform(F.filter(words, lambda w: ~w.rlike(INITIALISM)), _core)
        cores = F.filter(cores, lambda w: (w != "") & ~w.rlike("\\p{Nd}"))
        return let(cores, lambda cs: decide(cs, initials))

    return let(F.split(collapse(c), " "), from_words)


def _capitalized(core: Column) -> Column:
    return F.concat(F.upper(F.substring(core, 1, 1)), F.lower(F.substr(core, F.lit(2))))


def _title_word(token: Column, first: Column, short_caps_stay: Column) -> Column:
    part = lambda g: F.regexp_extract(token, WORD_PARTS, g)

    def recase(core: Column) -> Column:
        small = F.lower(core).isin(SMALL_WORDS)
        all_caps = core.rlike("^\\p{L}+$") & _is_upper(core)
        stays = short_caps_stay & (F.length(core) <= SHORT_CAPS)
        return (
            F.when(small, F.when(first, _capitalized(core)).otherwise(F.lower(core)))
            .when(all_caps, F.when(stays, core).otherwise(_capitalized(core)))
            .otherwise(capitalize_first_letter(core))
        )

    untouched = token.rlike(INITIALISM) | token.rlike("\\p{Nd}")
    return let(part(2), lambda core: F.when(
        untouched | (core == "") | core.rlike(INITIALS_CORE) | core.rlike(ROMAN_NUMERAL), token
    ).otherwise(F.concat(part(1), recase(core), part(3))))


def title_case(c: Column, short_caps_stay: Column | bool = True) -> Column:
    """Readable capitals: small words small except in front, long capital words as ordinary words."""
    short_caps_stay = F.lit(short_caps_stay) if isinstance(short_caps_stay, bool) else short_caps_stay

    def word(w: Column, i: Column) -> Column:
        parts = F.transform(F.split(w, "-"), lambda p, j: _title_word(p, (i == 0) & (j == 0), short_caps_stay))
        return F.array_join(parts, "-")

    x = initials_spacing(c)
    return F.when(x == "", x).otherwise(F.array_join(F.transform(F.split(x, " "), word), " "))


def readable(c: Column) -> Column:
    """Title case where the text is in capitals, otherwise only the first letter raised."""
    return let(initials_spacing(c), lambda x: let(caps_kind(x), lambda kind: (
        F.when(kind == "none", capitalize_first_letter(x)).otherwise(title_case(x, kind == "all")))))


def _alternation(forms: list[str]) -> str:
    longest_first = sorted(forms, key=len, reverse=True)
    return "(?iU)^(" + "|".join(f.replace(".", "\\.") for f in longest_first) + ")(?!\\S)"


ABBREVIATION_PREFIX = _alternation(FORM_ABBREVIATIONS)
FORM_NAME_PREFIX = _alternation(FORM_NAMES)


def _lstrip(c: Column) -> Column:
    return F.ltrim(c, F.lit(WHITE_SPACE))


def abbreviation_prefix(c: Column) -> Column:
    """struct(form, rest) for a leading legal-form abbreviation, or null."""
    hit = F.regexp_extract(c, ABBREVIATION_PREFIX, 1)
    return F.when(hit != "", F.struct(F.upper(hit).alias("form"), _lstrip(F.substr(c, F.length(hit) + 1)).alias("rest")))


def form_name_prefix(c: Column) -> Column:
    """struct(form, rest) for a leading legal form written out, in its canonical spelling, or null."""
    hit = F.regexp_extract(c, FORM_NAME_PREFIX, 1)
    canonical = F.create_map(*[F.lit(x) for f in FORM_NAMES for x in (f.lower(), f)])
    return F.when(hit != "", F.struct(
        F.try_element_at(canonical, F.lower(hit)).alias("form"), _lstrip(F.substr(c, F.length(hit) + 1)).alias("rest")))


def legal_form_prefix(c: Column) -> Column:
    return F.coalesce(abbreviation_prefix(c), form_name_prefix(c))


def split_name_tail(c: Column) -> Column:
    """struct(name, tail): the tail begins with a word for a branch or unit."""
    pattern = "(?s)^(.*?)(" + TAIL_START + ".*)$"
    x = strip(c)
    cut = x.rlike(pattern)
    return F.struct(
        F.when(cut, strip(F.regexp_extract(x, pattern, 1))).otherwise(x).alias("name"),
        F.when(cut, strip(F.regexp_extract(x, pattern, 2))).otherwise("").alias("tail"),
    )


def _display_form(c: Column) -> Column:
    """A legal form in its listed spelling; an unknown one gets a capital letter."""
    def choose(ab: Column, full: Column) -> Column:
        pick = F.when(ab["rest"] == "", ab).otherwise(F.coalesce(full, ab))
        return let(pick, lambda p: (
            F.when(p.isNull(), capitalize_first_letter(c))
            .when(p["rest"] == "", p["form"])
            .otherwise(F.concat(p["form"], F.lit(" "), readable(p["rest"])))))

    return let(abbreviation_prefix(c), lambda ab: let(form_name_prefix(c), lambda full: choose(ab, full)))


def _reading(x: Column) -> Column:
    """How a name is read: struct(shape, form, name, tail)."""
    def shape(kind: str, form: Column, name: Column, tail: Column) -> Column:
        return F.struct(F.lit(kind).alias("shape"), form.alias("form"), name.alias("name"), tail.alias("tail"))

    none = F.lit("")
    part = lambda g: strip(F.regexp_extract(x, QUOTED_NAME, g))
    quoted = F.coalesce(x.rlike(QUOTED_NAME) & (part(2) != ""), F.lit(False))
    by_form = lambda hit: let(split_name_tail(hit["rest"]), lambda p: shape("form", hit["form"], p["name"], p["tail"]))
    return let(legal_form_prefix(x), lambda hit: (
        F.when(quoted, shape("form", part(1), collapse(part(2)), part(3)))
        .when(hit.isNotNull(), by_form(hit))
        .when(x.rlike(NAME_HINT) & ~x.contains('"'), shape("name_only", none, x, none))
        .otherwise(shape("plain", none, x, none))))


def opf_quoted(c: Column) -> Column:
    """Legal form + quoted name + tail, when the text can be read that way.

    A bare name passes the capital rule twice, as its reading and its quoting
    each apply it.
    """
    def put(r: Column, form: Column, name: Column, tail: Column) -> Column:
        quoted = F.when(name != "", F.concat(F.lit('"'), name, F.lit('"'))).otherwise("")
        whole = F.array_join(F.filter(F.array(form, quoted, tail), lambda x: x != ""), " ")
        return F.when(r["shape"] == "plain", name).when((name != "") & (tail == ""), whole).otherwise(collapse(whole))

    def body(r: Column) -> Column:
        once = readable(r["name"])
        name = let(once, lambda n: F.when(r["shape"] == "name_only", readable(n)).otherwise(n))
        return let(_display_form(r["form"]), lambda f: let(name, lambda n: let(readable(r["tail"]), lambda t: put(r, f, n, t))))

    return let(collapse(c), lambda x: let(_reading(x), body))


def normalize_display_name(c: Column) -> Column:
    """The display form of an organisation name; blank texts stay as they are."""
    shown = let(opf_quoted(typography(c)), lambda d: F.when(d != "", d).otherwise(strip(c)))
    return F.when(is_blank(c), c).otherwise(shown)


def fingerprint_of_display(display: Column) -> Column:
    return F.lower(collapse(F.replace(display, F.lit('"'), F.lit(""))))


def name_fingerprint(c: Column) -> Column:
    return fingerprint_of_display(normalize_display_name(c))


def name_changed(c: Column, display: Column) -> Column:
    return F.when(is_blank(c), F.lit(False)).otherwise(display != collapse(c))
