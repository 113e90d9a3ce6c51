"""Record rules on small XML inputs."""

import pytest
from conftest import certificate, program, supplement, tags
from pyspark.sql import functions as F

from certweave.functions import nested as N
from certweave.operators import backfill, convert, filters, projection, repair, report
from certweave.operators.clean import WARNING_COUNTERS
from certweave.sources import sinks


def run(df, overrides=None, **options):
    return convert.convert_records(df, overrides, convert.Options(**options))


def written(df):
    return [r.Id for r in df.where(F.col("disposition") == filters.WRITTEN).orderBy("_record_seq").collect()]


def test_types_and_wrappers(xml):
    row = xml(certificate(IsFederal="1", IssueDate="15.01.2025", RegNumber=" RN 1\n2", SerialNumber="—", EduOrgINN="77 00-1",
                          sups=supplement(IsForBranch="0") + supplement("s2", IsForBranch="1"))).first()
    assert (row.IsFederal, row.IssueDate, row.RegNumber, row.SerialNumber, row.EduOrgINN) == (True, "2025-01-15", "RN 1 2", None, "77001")
    assert [s.IsForBranch for s in row.Supplements] == [False, True] and row.Decisions == []


def test_warnings_are_counted(xml):
    df = run(xml(certificate(IsFederal="возможно", IssueDate="вчера", EduOrgINN="1X", sups=supplement(IssueDate="завтра", EduOrgKPP="K"))))
    total = report.conversion_report(df).where("source_file = '<total>'").first()
    assert (total.bad_dates, total.bad_booleans, total.non_digit_ids) == (2, 1, 2)


def test_broken_element_does_not_take_its_neighbours(xml):
    df = xml(certificate("a") + "<Certificate><Id>b</Wrong></Certificate>" + certificate("c", RegNumber="x & y"))
    rows = df.orderBy("_record_seq").collect()
    assert [r.Id for r in rows if r._corrupt_record is None] == ["a", "c"] and rows[2].RegNumber == "x y"
    assert report.conversion_report(run(df)).where("source_file = '<total>'").first().skipped == 1


def test_strict_fails(xml):
    with pytest.raises(Exception):
        xml("<Certificate><Id>b</Wrong></Certificate>", strict=True).collect()


def test_status_region_and_blocklist(xml):
    df = xml(certificate("a", StatusName="Действующее") + certificate("b", StatusName="Недействующее") + certificate("p", StatusName="Прекращено")
             + certificate("r", RegionName=filters.OUTSIDE_REGION) + certificate("C68F57A6-e846-f050-fba2-011a5f71ab8c"))
    assert written(run(df)) == ["a"]
    assert written(run(df, omit_inactive=False, omit_outside_region=False)) == ["a", "b", "p", "r"]
    total = report.conversion_report(run(df)).where("source_file = '<total>'").first()
    assert (total.processed, total.omitted_inactive, total.omitted_outside_region, total.omitted_blocklist) == (1, 2, 1, 1)


def test_supplements_in_excluded_status(xml):
    body = certificate(sups=supplement("a", StatusName="Действующее") + supplement("b", StatusName="Прекращено") + supplement("c", StatusName="Лишен аккредитации"))
    row = run(xml(body)).first()
    assert [s.Id for s in row.Supplements] == ["a"] and row.stripped_supplements_by_status == 2
    assert len(run(xml(body), omit_inactive=False).first().Supplements) == 3


def test_invalid_ogrn_on_request(xml):
    df = xml("".join(certificate(i, EduOrgOGRN=o) for i, o in (("a", "102770"), ("b", "1 02 770"), ("c", ""), ("d", "АБВ"))) + certificate("e"))
    assert written(run(df)) == ["a", "b", "c", "d", "e"]
    assert written(run(df, omit_invalid_ogrn=True)) == ["a", "b"]


def test_coherent_fill_chain(xml):
    row = run(xml(certificate(EduOrgINN="7700000001", root=tags(Id="X", OGRN="1"), sups=supplement(card=tags(Id="x", OGRN="1"))))).first()
    assert row.ActualEducationOrganization._derived.INN == row.Supplements[0].ActualEducationOrganization._derived.INN == "7700000001"
    assert (row.coherent_root_inn, row.coherent_supplement_inn) == (1, 1) and row.ActualEducationOrganization.INN is None


def test_root_fill_from_supplement_and_back_to_certificate(xml):
    row = run(xml(certificate(root=tags(Id="x", OGRN="5"), sups=supplement(card=tags(Id="X", INN="7700000002"))))).first()
    assert row.ActualEducationOrganization._derived.INN == "7700000002"
    assert row._derived.EduOrgINN == "7700000002" and row._derived.EduOrgOGRN == "5" and row.eduorg_inn_from_supplement == 1


def test_branch_fill_and_its_switch(xml):
    df = xml(certificate(root=tags(Id="x", INN="1", OGRN="2"), sups=supplement(card=tags(Id="y"))))
    card = run(df).first().Supplements[0].ActualEducationOrganization
    assert (card._derived.INN, card._derived.OGRN) == ("1", "2")
    assert run(df).first().branch_supplement_inn == 1
    assert run(df, fill_ids=False).first().Supplements[0].ActualEducationOrganization._derived.INN is None


def test_head_ids_must_not_contradict(xml):
    df = xml(certificate(root=tags(Id="x", HeadEduOrgId="h1", INN="1"), sups=supplement(card=tags(Id="x", HeadEduOrgId="h2", OGRN="3"))))
    assert run(df).first().Supplements[0].ActualEducationOrganization._derived.INN is None


def test_override_by_ogrn(spark, xml):
    table = spark.sql("select '1026700630615' as ogrn, '6712005793' as inn")
    hit = certificate("a", EduOrgOGRN="1026700630615", root=tags(Id="x"))
    clash = certificate("b", EduOrgOGRN="1026700630615", root=tags(Id="x", OGRN="7"))
    a, b = run(xml(hit + clash), table).orderBy("_record_seq").collect()
    assert a._derived.EduOrgINN == a.ActualEducationOrganization._derived.INN == "6712005793" and a.override_records == 1
    assert b._derived.EduOrgINN is None and b.override_records == 0
    assert run(xml(hit), table, fill_ids=False).first()._derived.EduOrgINN == "6712005793"


def test_degenerate_shell(xml):
    row = run(xml(certificate(EduOrgKPP="9", root=tags(Id="x", INN="1", OGRN="2"), sups=supplement(card=tags(RegionName="R"))))).first()
    d = row.Supplements[0].ActualEducationOrganization._derived
    assert (d.INN, d.OGRN, d.KPP) == ("1", "2", "9") and (row.shell_cards, row.shell_kpp) == (1, 1)


def levels(row):
    return [(p._derived.EduLevelName, p.EduLevelName) for s in row.Supplements for p in s.EducationalPrograms]


def test_level_rules(xml):
    progs = (program("1", ProgrammName="Основное общее образование", ProgrammCode="--") + program("2", EduLevelName="Общее образование")
             + program("3", EduLevelName="ВО - бакалавриат") + program("4", EduLevelName="Дошкольное образование")
             + program("5", EduLevelName="Не определен") + program("6", EduLevelName="Новый уровень") + program("7"))
    row = run(xml(certificate(sups=supplement(progs=progs)))).first()
    assert levels(row) == [("Основное общее образование", None), ("Основное общее образование", "Общее образование"),
                           ("Высшее образование - бакалавриат", "ВО - бакалавриат"), (None, "Дошкольное образование"), (None, None), (None, "Новый уровень")]
    assert (row.level_from_name, row.levels_renamed, row.levels_cleared, row.levels_unknown, row.stripped_stub_programs) == (1, 2, 1, 1, 1)


def test_branch_marks(xml):
    sups = supplement("a", card=tags(Id="X")) + supplement("b", card=tags(Id="x")) + supplement("c", IsForBranch="1") + supplement("d") + supplement("e", card=tags(FullName="n"))
    row = run(xml(certificate(root=tags(Id="x"), sups=sups))).first()
    assert [s._derived.IsBranchSupplement for s in row.Supplements] == [True, False, True, False, True] and row._derived.HasBranchSupplements


def test_neighbours_fill_across_records(xml):
    receiver = certificate("a", sups=supplement(progs=program(ProgrammCode="380301", ProgrammName="П")))
    donor = certificate("b", sups=supplement(progs=program(ProgrammCode="38.03.01", EduLevelName="ВО - бакалавриат")))
    df = convert.written_records(run(xml(receiver + donor)))
    a, b = backfill.neighbor_backfill(df).orderBy("_record_seq").collect()
    assert levels(a)[0][0] == levels(b)[0][0] == "Высшее образование - бакалавриат"
    assert (a.levels_from_neighbors, b.levels_from_neighbors) == (1, 0)


def test_level_table_maps_as_literals_do(spark, xml):
    df = xml(certificate("a", sups=supplement(progs="".join(program(ProgrammCode="380301", EduLevelName=n) for n in ("Не определен", "Общее образование", "Дошкольное образование", "x", "")))) + certificate("b"))
    rows = [(k, v, "clear" if v is None else "rename") for k, v in repair.LEVEL_TARGETS.items()] + [(k, k, "canonical") for k in repair.CANONICAL_LEVELS]
    table = spark.createDataFrame(rows, "level string, target string, role string")
    counters = ["levels_renamed", "levels_cleared", "levels_unknown"]
    got = backfill.map_levels_by(df, table).orderBy("_record_seq").select("Id", "Supplements", *counters).collect()
    assert got == repair.map_levels(df).orderBy("_record_seq").select("Id", "Supplements", *counters).collect() and got[0].levels_cleared == 1


def test_damaged_records_are_skipped_everywhere(xml):
    done = run(xml(certificate("good") + "<Certificate><Id>open</Id>" + certificate("next") + "<Certificate/>" + certificate("last") + "<Certificate><Id>bad</Id><X></Certificate>"))
    assert [r.Id for r in convert.written_records(done).orderBy("_record_seq").collect()] == ["good", "next", None, "last"]
    total = report.conversion_report(done).where("source_file = '<total>'").first()
    assert (total.processed, total.skipped) == (4, 2)
    assert done.where("_corrupt_record is not null").count() == 2


def test_majority_ties_take_the_smaller_text(spark):
    rows = spark.createDataFrame([("f", "c", "b"), ("f", "c", "a"), ("f", "d", "z"), ("f", "d", "z"), ("f", "d", "a")], "scope string, code string, level string")
    got = {r.code: r.level for r in backfill.majority_level(backfill.level_histogram_by_code(rows)).collect()}
    assert got == {"c": "a", "d": "z"}


def test_projection_groups_branches(xml):
    b = lambda i, **f: supplement(i, IsForBranch="1", card=tags(**f), progs=program(ProgrammCode="38.03.0" + i, EduLevelName="Дошкольное образование"))
    sups = b("1", OGRN="9", Id="p", ShortName="МБОУ «Один»") + b("2", OGRN="9", Id="q") + b("3", Id="r") + supplement("4")
    df = xml(certificate(RegionName="Брянская область", root=tags(Id="x", FormName="Муниципальное учреждение"), sups=sups))
    row = projection.with_graph(run(df, fill_ids=False)).first()._graph
    assert [(x.ogrn, x.display_name, len(x.programs)) for x in row.branches] == [("9", "Один", 2), (None, None, 1)]
    assert row.org.founder_key == "municipal:Брянская область" and row.region_short == "Брянская" and row.edu_levels == []


def test_compact_json_leaves_out_empty_members(xml):
    df = xml(certificate(RegNumber=" ", IsFederal="0", sups=supplement(card=tags(Id=" ")))).drop(*WARNING_COUNTERS)
    text = sinks.json_lines(df).first().value
    assert text == '{"Id":"c1","IsFederal":false,"Supplements":[{"Id":"s1"}]}'


def test_reads_do_not_see_a_missing_derived_struct_as_a_hole(spark):
    from certweave.sources.readers import parse_records

    lines = spark.createDataFrame([('{"Id":"c","EduOrgINN":"5","ActualEducationOrganization":{"Id":"x"}}', "f", 0)], "value string, _source_file string, _record_seq bigint")
    row = repair.fill_coherent_ids(parse_records(lines)).first()
    assert row.ActualEducationOrganization._derived.INN == "5" and N.SUPPLEMENTS in row.asDict()
