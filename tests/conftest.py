import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from certweave.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="4", shuffle_partitions=4, driver_memory="4g")
    # a handful of rows per test: interpreting a plan is quicker than compiling it
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    session.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    return session


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def xml(spark, tmp_path):
    """Records of an XML text: cleaned, typed and stored, as an ingest job leaves them."""
    from certweave.operators.clean import clean_records
    from certweave.sources.readers import read_xml

    def load(body, strict=False):
        path, stored = tmp_path / "snapshot.xml", str(tmp_path / uuid.uuid4().hex)
        path.write_text(f'<?xml version="1.0" encoding="utf-8"?>\n<OpenData><Certificates>{body}</Certificates></OpenData>', encoding="utf-8")
        clean_records(read_xml(spark, str(path), strict=strict)).write.parquet(stored)
        return spark.read.parquet(stored)

    return load


def certificate(id="c1", *, root="", sups="", **fields):
    cells = "".join(f"<{k}>{v}</{k}>" for k, v in fields.items())
    card = f"<ActualEducationOrganization>{root}</ActualEducationOrganization>" if root else ""
    wrap = f"<Supplements>{sups}</Supplements>" if sups else ""
    return f"<Certificate><Id>{id}</Id>{cells}{card}{wrap}</Certificate>"


def supplement(id="s1", *, card="", progs="", **fields):
    cells = "".join(f"<{k}>{v}</{k}>" for k, v in fields.items())
    org = f"<ActualEducationOrganization>{card}</ActualEducationOrganization>" if card else ""
    wrap = f"<EducationalPrograms>{progs}</EducationalPrograms>" if progs else ""
    return f"<Supplement><Id>{id}</Id>{cells}{org}{wrap}</Supplement>"


def program(id="p1", **fields):
    return f"<EducationalProgram><Id>{id}</Id>" + "".join(f"<{k}>{v}</{k}>" for k, v in fields.items()) + "</EducationalProgram>"


def tags(**fields):
    return "".join(f"<{k}>{v}</{k}>" for k, v in fields.items())
