import bz2
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("dumptables-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


HEADER = """<mediawiki><siteinfo><sitename>Site</sitename><dbname>{dbname}</dbname>
<base>http://x/</base><generator>g</generator><case>first-letter</case><namespaces>
<namespace key="0" case="first-letter" /><namespace key="1" case="first-letter">Talk</namespace>
<namespace case="first-letter">No key</namespace></namespaces></siteinfo>
"""
END = "</mediawiki>\n"


def header(dbname="testwiki"):
    return HEADER.format(dbname=dbname)


def bz2_streams(*chunks):
    """Each chunk compressed on its own, then joined, as multistream dumps are."""
    return b"".join(bz2.compress(c.encode()) for c in chunks)


@pytest.fixture
def write_dump(tmp_path):
    """Write ``name -> chunks`` as multistream bz2 files into one folder."""

    def write(folder="dump", **files):
        path = tmp_path / folder
        path.mkdir(exist_ok=True)
        for name, chunks in files.items():
            (path / f"{name}.xml.bz2").write_bytes(bz2_streams(*chunks))
        return str(path)

    return write


def rows_of(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
