"""Register-shaped records over the order tables.

The driver tables hold no register data, so each order becomes one record: its
customer and nation give the certificate fields, and the order key gives a fixed
small number of supplements (0-3), programmes (0-3 each) and decisions (0-2).
Building a record touches only its own row, so no key of the tables can make a
record, a group or a task grow.

The field rules are plain SQL ``CASE`` text. The same text builds the nested
records here and, flattened, the views that the DuckDB checks start from, which
keeps both sides of a check on the same input.

Letters in the rules: ``k`` order key, ``c`` customer key, ``nk``/``nn`` nation,
``seg`` market segment, ``cn`` customer name, ``d`` order date as text, ``i`` /
``j`` / ``x`` position of a supplement / programme / decision.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from certweave import schema as S
from certweave.session import scratch_path

CERTIFICATE_RULES = {
    "Id": "case when k % 211 = 5 then null when k % 53 = 7 then 'c'||(k-1) else 'c'||k end",
    "IsFederal": "case when k % 17 = 0 then null else k % 3 = 0 end",
    "StatusName": "case k % 10 when 0 then 'Недействующее' when 1 then 'Прекращено' when 2 then null when 3 then '  ' "
                  "when 4 then 'Переоформлено' else 'Действующее' end",
    "TypeName": "case k % 3 when 0 then 'Свидетельство о государственной аккредитации' "
                "when 1 then 'Временное свидетельство' else null end",
    "RegionName": "case when nk = 24 then 'образовательные учреждения, находящиеся за пределами Российской Федерации' "
                  "when nk % 3 = 0 then nn||' область' when nk % 3 = 1 then 'Республика '||nn else 'г. '||nn end",
    "RegionCode": "''||nk",
    "RegNumber": "'РН-'||k",
    "IssueDate": "d",
    "ControlOrgan": "case k % 9 when 0 then 'Федеральная служба по надзору в сфере образования и науки' "
                    "when 1 then 'Министерство образования и науки Брянской области' "
                    "when 2 then 'Министерство образования и молодёжной политики Республики Татарстан' "
                    "when 3 then 'Департамент образования и молодежной политики Ярославской области' "
                    "when 4 then 'Комитет по образованию г. Санкт-Петербурга' "
                    "when 5 then 'Управление образования Ханты-Мансийского автономного округа — Югры' "
                    "when 6 then 'Министерство просвещения Чувашской Республики' "
                    "when 7 then 'Инспекция по контролю качества знаний региона номер '||nk else null end",
    "EduOrgFullName": "case k % 6 when 0 then 'Муниципальное бюджетное общеобразовательное учреждение «Школа № '||(c % 90)||'»' "
                      "when 1 then 'Федеральное государственное бюджетное образовательное учреждение высшего образования "
                      "\"'||seg||' государственный университет\"' "
                      "when 2 then 'ЛИЦЕЙ ИМЕНИ М. В. ЛОМОНОСОВА' "
                      "when 3 then 'Автономная некоммерческая организация Колледж '||cn when 4 then null else '  ' end",
    "EduOrgShortName": "case k % 5 when 0 then 'МБОУ «Школа № '||(c % 90)||'»' when 1 then 'ФГБОУ ВО '||seg when 2 then null "
                       "when 3 then 'МБОУ ДОмовёнок' else 'АНО СПО «'||cn||'»' end",
    "EduOrgINN": "case k % 4 when 0 then null when 1 then '77 '||lpad(''||k,8,'0') when 2 then '12X'||k "
                 "else '770-'||lpad(''||k,7,'0') end",
    "EduOrgKPP": "case when k % 3 = 0 then '7701'||lpad(''||c,5,'0') else null end",
    "EduOrgOGRN": "case k % 5 when 0 then null when 1 then '1026700630615' when 2 then '10277'||lpad(''||c,8,'0') "
                  "when 3 then 'отсутствует' else '1 0277 '||lpad(''||c,7,'0') end",
}
ROOT_PRESENT = "k % 13 <> 0"
ROOT_RULES = {
    "Id": "case when k % 7 = 6 then null else 'aeo-'||(c % 50) end",
    "FullName": "case k % 7 when 0 then null when 1 then 'МБОУ \"СОШ №'||(c % 90)||'\" филиал' "
                "when 2 then 'Частное учреждение ЮЖНЫЙ Федеральный ЦЕНТР' "
                "when 3 then 'Муниципальное бюджетное общеобразовательное учреждение Брянской области «Гимназия «Искра»»' "
                "when 4 then 'Муниципальное бюджетное профессиональное образовательное учреждение Техникум '||cn "
                "when 5 then '„„Колледж““ – '||seg else 'средняя школа №'||(k % 30) end",
    "ShortName": "case k % 4 when 0 then null when 1 then 'ГБОУ «Лицей № '||(c % 20)||'»' when 2 then 'МБОУ СОШ № '||(c % 90) "
                 "else 'ОЧЕНЬ ДЛИННОЕ СОКРАЩЁННОЕ НАИМЕНОВАНИЕ ОРГАНИЗАЦИИ ДЛЯ ПРОВЕРКИ ДЛИНЫ '||cn end",
    "HeadEduOrgId": "case when k % 4 = 1 then 'head-'||(c % 5) else null end",
    "IsBranch": "k % 2 = 0",
    "OGRN": "case k % 5 when 0 then null when 1 then null when 2 then '10277'||lpad(''||c,8,'0') "
            "when 3 then '20277'||lpad(''||c,8,'0') else ' ' end",
    "INN": "case k % 6 when 0 then null when 1 then '78'||lpad(''||c,8,'0') when 2 then '  ' when 3 then null "
           "when 4 then '78 '||lpad(''||k,8,'0') else 'x1' end",
    "KPP": "case when k % 2 = 0 then null else '77'||lpad(''||c,7,'0') end",
    "FormName": "case k % 6 when 0 then 'Муниципальное бюджетное учреждение' when 1 then 'Государственное бюджетное учреждение' "
                "when 2 then 'Частное учреждение' when 3 then 'Автономная некоммерческая организация' when 4 then null "
                "else 'Товарищество' end",
    "RegionName": "case when k % 3 = 0 then null when k % 3 = 1 then ' Республика '||nn||' ' else 'г. '||nn end",
}
SUPPLEMENT_RULES = {
    "Id": "case when k % 67 = 3 and i = 1 then null when k % 71 = 3 and i = 2 then 's'||k||'-0' else 's'||k||'-'||i end",
    "StatusName": "case {s} % 6 when 0 then 'Недействующее' when 1 then null when 2 then ' Прекращено ' when 3 then '' "
                  "else 'Действующее' end",
    "Number": "case {s} % 3 when 0 then null else 'N'||i end",
    "IssueDate": "d",
    "IsForBranch": "case {s} % 5 when 0 then true when 1 then null else false end",
    "EduOrgAddress": "'адрес '||nk",
}
CARD_PRESENT = "{s} % 5 <> 1"
CARD_RULES = {
    "Id": "case {s} % 4 when 0 then 'AEO-'||(c % 50) when 1 then 'aeo-b'||(k % 11) when 2 then null else 'aeo-'||(c % 50) end",
    "FullName": "case {s} % 3 when 0 then 'Филиал «Школа № '||({s} % 90)||'» в городе' when 1 then 'МБОУ СОШ №'||i else null end",
    "ShortName": "case {s} % 4 when 0 then null when 1 then 'МБОУ «Филиал № '||i||'»' else 'ЧОУ '||seg end",
    "HeadEduOrgId": "case when {s} % 3 = 1 then 'HEAD-'||(c % 5) else null end",
    "OGRN": "case {s} % 3 when 0 then null when 1 then '30277'||lpad(''||(k % 50),8,'0') else '  ' end",
    "INN": "case {s} % 4 when 0 then null when 1 then null when 2 then '50'||lpad(''||k,8,'0') "
           "else case when k % 2 = 0 then '51-'||lpad(''||k,8,'0') else 'нет ИНН' end end",
    "KPP": "case when {s} % 7 = 0 then null else '50'||lpad(''||c,7,'0') end",
    "RegionName": "case when {s} % 4 = 0 then 'г. '||nn else null end",
}
PROGRAM_RULES = {
    "Id": "case when {p} % 11 = 0 then null else 'p'||({p} % 7) end",
    "TypeName": "case when {p} % 2 = 0 then 'Основная' else null end",
    "EduLevelName": "case {p} % 9 when 0 then null when 1 then 'ВО - бакалавриат' when 2 then 'Не определен' "
                    "when 3 then 'Среднее общее образование' when 4 then 'Общее образование' "
                    "when 5 then 'Среднее профессиональное образование' when 6 then '  ' "
                    "when 7 then 'Высшее образование - подготовка кадров высшей квалификации' else 'Иной уровень образование' end",
    "ProgrammName": "case {p} % 8 when 0 then null when 1 then 'Основное общее образование' "
                    "when 2 then ' Начальное общее образование' else 'Программа '||({p} % 13) end",
    "ProgrammCode": "case {p} % 5 when 0 then lpad(''||({p} % 40),2,'0')||'0301' when 1 then '--' when 2 then null "
                    "when 3 then lpad(''||({p} % 40),2,'0')||'.06.01' else lpad(''||({p} % 40),2,'0')||'.03.0'||({p} % 3) end",
    "UGSName": "case {p} % 4 when 0 then null when 1 then '' else 'УГС '||({p} % 12) end",
    "UGSCode": "case {p} % 3 when 0 then null when 1 then lpad(''||({p} % 40),2,'0')||'.00.00' else 'bad' end",
    "Qualification": "case {p} % 6 when 0 then null when 1 then 'Бакалавр.' when 2 then 'Бакалавр' when 3 then ' ' "
                     "when 4 then 'Юрист . ' else 'Специалист' end",
    "IsAccredited": "{p} % 2 = 0",
}
DECISION_RULES = {
    "Id": "case when (k + x) % 4 = 0 then null when (k + x) % 9 = 1 then '  ' when k % 83 = 2 then 'd'||k "
          "else 'd'||k||'-'||x end",
    "DecisionTypeName": "case (k + x) % 3 when 0 then 'О предоставлении' when 1 then 'О переоформлении' else null end",
    "DecisionDate": "d",
}
SUPPLEMENT_COUNT = "k % 4"
PROGRAM_COUNT = "{s} % 4"
DECISION_COUNT = "k % 3"

S_TERM = "(k + i)"
P_TERM = "(3 * k + 5 * i + j)"


def _fill(rule: str) -> str:
    return rule.replace("{s}", S_TERM).replace("{p}", P_TERM)


def _spark_type(name: str) -> str:
    return "boolean" if name in S.BOOL_FIELDS else "string"


def _named_struct(fields: list[str], rules: dict[str, str], extra: list[tuple[str, str]] = ()) -> str:
    parts = [f"'{f}', cast(({_fill(rules[f])}) as {_spark_type(f)})" if f in rules
             else f"'{f}', cast(null as {_spark_type(f)})" for f in fields]
    parts += [f"'{name}', {expr}" for name, expr in extra]
    return "named_struct(" + ", ".join(parts) + ")"


def _empty(members: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{k}', cast(null as {v})" for k, v in members.items()) + ")"


def _each(letter: str, most: int, count: str, item: str) -> str:
    """Array of ``item`` for the positions below ``count``; ``most`` is the fixed upper end."""
    slots = ", ".join(str(n) for n in range(most))
    return f"transform(filter(array({slots}), {letter} -> {letter} < {_fill(count)}), {letter} -> {item})"


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with the letters the field rules use."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    rows = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .select(
            F.col("o_orderkey").alias("k"),
            F.col("o_custkey").alias("c"),
            F.col("n_nationkey").alias("nk"),
            F.col("n_name").alias("nn"),
            F.col("c_mktsegment").alias("seg"),
            F.col("c_name").alias("cn"),
            F.col("o_orderdate").cast("date").cast("string").alias("d"),
        )
    )
    return spread_few_files(rows, len(orders.inputFiles()), "k")


def spread_few_files(df: DataFrame, files: int, *unique_key: str) -> DataFrame:
    """Rows of an input with fewer files than cores, spread over all cores.

    One small file is one task. A large input comes in many files and needs no
    extra shuffle, so nothing happens then.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *unique_key) if files < cores else df


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed, not yet repaired records; ``_record_seq`` is the order key."""
    card = f"case when {_fill(CARD_PRESENT)} then " + _named_struct(
        S.ORGANIZATION_FIELDS, CARD_RULES, [("_derived", _empty(S.ORGANIZATION_DERIVED))]) + " end"
    programs = _each("j", 3, PROGRAM_COUNT, _named_struct(
        S.PROGRAM_FIELDS, PROGRAM_RULES, [("_derived", _empty(S.PROGRAM_DERIVED))]))
    supplements = _each("i", 3, SUPPLEMENT_COUNT, _named_struct(
        S.SUPPLEMENT_FIELDS, SUPPLEMENT_RULES,
        [(S.ORGANIZATION, card), ("EducationalPrograms", programs), ("_derived", _empty(S.SUPPLEMENT_DERIVED))]))
    decisions = _each("x", 2, DECISION_COUNT, _named_struct(S.DECISION_FIELDS, DECISION_RULES))
    root = f"case when {ROOT_PRESENT} then " + _named_struct(
        S.ORGANIZATION_FIELDS, ROOT_RULES, [("_derived", _empty(S.ORGANIZATION_DERIVED))]) + " end"
    columns = [f"cast(({CERTIFICATE_RULES[f]}) as {_spark_type(f)}) as {f}" if f in CERTIFICATE_RULES
               else f"cast(null as {_spark_type(f)}) as {f}" for f in S.CERTIFICATE_FIELDS]
    return order_rows(spark, sf_dir).selectExpr(
        *columns,
        f"{root} as {S.ORGANIZATION}",
        f"{supplements} as Supplements",
        f"{decisions} as Decisions",
        f"{_empty(S.CERTIFICATE_DERIVED)} as _derived",
        "'snapshot-'||(k % 5)||'.xml' as _source_file",
        "k as _record_seq",
    )


def stored_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records written once as Parquet and read back, for a job that passes over them several times."""
    path = scratch_path(spark, "records")
    records(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def oracle_views(*names: str) -> str:
    """``WITH`` prefix for DuckDB: flat views ``cert``, ``sup``, ``prog``, ``dec`` over the same rules.

    Root card fields carry the prefix ``r_``, supplement card fields ``a_``,
    supplement fields in ``prog`` are reached over (k, i).
    """
    def cols(fields, rules, prefix="", present=None):
        out = []
        for f in fields:
            if f in rules:
                e = _fill(rules[f])
                out.append(f"case when {_fill(present)} then ({e}) end as {prefix}{f}" if present else f"({e}) as {prefix}{f}")
            else:
                kind = "boolean" if f in S.BOOL_FIELDS else "varchar"
                out.append(f"cast(null as {kind}) as {prefix}{f}")
        return ", ".join(out)

    text = {
        "base": "select o_orderkey as k, o_custkey as c, n_nationkey as nk, n_name as nn, c_mktsegment as seg, c_name as cn, "
                "cast(cast(o_orderdate as date) as varchar) as d "
                "from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey",
        "cert": f"select k, 'snapshot-'||(k % 5)||'.xml' as source_file, {cols(S.CERTIFICATE_FIELDS, CERTIFICATE_RULES)}, "
                f"({ROOT_PRESENT}) as has_root, {cols(S.ORGANIZATION_FIELDS, ROOT_RULES, 'r_', ROOT_PRESENT)} from base",
        "sup": f"select k, i, {cols(S.SUPPLEMENT_FIELDS, SUPPLEMENT_RULES)}, ({_fill(CARD_PRESENT)}) as has_card, "
               f"{cols(S.ORGANIZATION_FIELDS, CARD_RULES, 'a_', CARD_PRESENT)} "
               f"from base, (values (0),(1),(2)) as si(i) where i < {_fill(SUPPLEMENT_COUNT)}",
        "prog": f"select k, i, j, {cols(S.PROGRAM_FIELDS, PROGRAM_RULES)} "
                f"from base, (values (0),(1),(2)) as si(i), (values (0),(1),(2)) as pj(j) "
                f"where i < {_fill(SUPPLEMENT_COUNT)} and j < {_fill(PROGRAM_COUNT)}",
        "dec": f"select k, x, {cols(S.DECISION_FIELDS, DECISION_RULES)} "
               f"from base, (values (0),(1)) as dx(x) where x < {DECISION_COUNT}",
    }
    wanted = ["base", *[n for n in ("cert", "sup", "prog", "dec") if n in names]]
    return "with " + ",\n".join(f"{n} as ({text[n]})" for n in wanted)
