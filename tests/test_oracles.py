"""Queries against DuckDB on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from marketloom import plans

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents labels conversations".split()


def _plain(df: pd.DataFrame) -> list:
    df = df[sorted(df.columns)]
    def value(v):
        if pd.isna(v):
            return None
        if isinstance(v, (int, float)) or hasattr(v, "dtype"):
            return round(float(v), 5)
        return pd.Timestamp(v).isoformat() if hasattr(v, "year") else str(v)

    return sorted([tuple(map(value, r)) for r in df.itertuples(index=False)], key=str)


@pytest.mark.parametrize("name", ["POP_06", "POP_14", "POP_17", "SUP_01", "SUP_02", "SUP_09", "OPN_01", "DEM_05", "MON_02_05", "SCO_02", "SCO_04", "RUL_03", "QRY_10", "STA_03", "BTE_05", "REL_06", "SNK_01", "LEG_02", "MTR_07", "STR_03", "SRC_02", "SRC_03", "SRC_04", "SRC_07", "SRC_09", "SNK_04", "SNK_07", "POP_21", "BTE_01", "BTE_04", "PRO_08", "CAL_02", "QRY_09", "MTR_06", "LEG_04", "LEG_12", "REL_03", "REL_05", "REL_10", "CAL_05", "POP_07", "POP_24", "DEM_07", "DEM_08", "SUP_10", "MTR_05", "RUL_05", "PRO_04", "BTE_07", "LEG_09", "LEG_13", "SRC_10", "SRC_15", "SRC_16", "SRC_12", "SAM_02", "STR_01", "STR_02", "SNK_03", "SNK_05", "STA_05", "STA_06", "STA_07", "STA_11", "STA_12", "PRO_06", "CAL_03", "SAM_03", "LEG_05", "LEG_06", "STR_04", "STR_05", "STR_06", "STR_07", "QRY_07", "BTE_04_cards", "SRC_03_stubs", "SRC_06", "LEG_14", "BTE_02", "BTE_02_report", "SRC_01_landed", "SNK_07_store", "STA_13_effects", "SCO_02_detail", "MTR_06_quota", "MTR_06_staleness", "QRY_09_cards", "QRY_09_drilldown", "POP_12", "POP_13", "POP_15", "POP_20", "DEM_03", "RUL_01", "QRY_04_feed", "QRY_05_steps", "RUL_05_feed", "QRY_08_lookup", "MTR_01_health", "BTE_07_controlled", "BTE_05_lag", "PRO_01_counts", "PRO_01_age", "PRO_03_counts", "LEG_01_profile", "CAL_01_bands", "MTR_04_channels", "POP_04_seeds", "POP_07_switch", "MTR_05_definitions", "REL_01", "MTR_02", "LEG_08", "CAL_01"])
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{DIR}/{t}.parquet')")
    assert _plain(plans.QUERIES[name](spark, DIR).toPandas()) == _plain(con.execute(plans.ORACLES[name]).fetchdf())
