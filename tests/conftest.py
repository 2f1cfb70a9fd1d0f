import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"

# Fixture rows printed in the exercises (flights: first five rows; sms: first four lines).
FLIGHTS_CSV = """mon,dom,dow,carrier,flight,org,mile,depart,duration,delay
11,20,6,US,19,JFK,2153,9.48,351,NA
0,22,2,UA,1107,ORD,316,16.33,82,30
2,20,4,UA,226,SFO,337,6.17,82,-8
9,13,1,AA,419,ORD,1236,10.33,195,-5
4,2,5,AA,325,ORD,258,8.92,65,NA
"""

SMS_CSV = """1;Sorry, I'll call later in meeting;0
2;Dont worry. I guess he's busy.;0
3;Call FREEPHONE 0800 542 0578 now!;1
4;Win a 1000 cash prize or a prize worth 5000;1
"""


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from sparkwright.session import shared_root
    shared_root(s)
    yield s


@pytest.fixture()
def write_text(tmp_path):
    def _write(name: str, content: str) -> str:
        d = tmp_path / name
        d.mkdir()
        (d / "part-0.csv").write_text(content)
        return str(d)
    return _write


@pytest.fixture(scope="session")
def flights_fixture(spark, tmp_path_factory):
    from sparkwright.sources import read_flights_csv
    d = tmp_path_factory.mktemp("flights")
    (d / "flights.csv").write_text(FLIGHTS_CSV)
    return read_flights_csv(spark, str(d), infer_schema=True)


@pytest.fixture(scope="session")
def sms_fixture(spark, tmp_path_factory):
    from sparkwright.sources import read_sms_csv
    d = tmp_path_factory.mktemp("sms")
    (d / "sms.csv").write_text(SMS_CSV)
    return read_sms_csv(spark, str(d))
