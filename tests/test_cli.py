"""The command line drives the batch jobs end to end."""

import glob

from fareflow.cli import main
from fareflow.sources import landing

from conftest import SF_SMALL


def test_cli_end_to_end(spark, scratch, capsys):
    bronze = landing.bronze_base(spark, SF_SMALL)
    zones = landing.zone_csv(spark, SF_SMALL)
    months = ["--year-months", "1996-01", "1996-02"]
    assert main(["profile", "--bronze", bronze, "--out", f"{scratch}/profile",
                 "--write-details", *months], spark) == 0
    assert glob.glob(f"{scratch}/profile/bronze_quality_summary/*.csv")
    assert glob.glob(f"{scratch}/profile/details/payment_type_distribution/year=1996/month=01/*.csv")
    assert glob.glob(f"{scratch}/profile/details/summary/year=1996/month=02/*.csv")
    assert main(["silver", "--bronze", bronze, "--silver", f"{scratch}/silver", *months],
                spark) == 0
    assert main(["validate", "--silver", f"{scratch}/silver", *months], spark) == 0
    assert main(["validate", "--silver", f"{scratch}/silver",
                 "--year-months", "1996-03"], spark) == 1
    assert main(["query", "--silver", f"{scratch}/silver", "--name", "aq1", *months],
                spark) == 0
    out = capsys.readouterr().out
    assert "1996" in out and "trip_count" in out
    assert main(["gold", "--silver", f"{scratch}/silver", "--zones", zones,
                 "--gold", f"{scratch}/gold", "--test"], spark) == 0
    args = ["gold", "--silver", f"{scratch}/silver", "--zones", zones, "--gold", f"{scratch}/gold"]
    capsys.readouterr()
    assert main([*args, *months], spark) == 0 and "complete" in capsys.readouterr().out
    assert main([*args, "--force", *months], spark) == 0 and "complete" not in capsys.readouterr().out
