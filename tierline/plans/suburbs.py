"""The suburb profile mart: six question views, a health view, eight chart datasets.

Each fact is published with its labels as a table by year, which is built again when a table it is made from
was published anew. The views are plans over these tables; nothing else is stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.operators import scoring
from tierline.operators.scoring import Factor, Mode
from tierline.plans import reports
from tierline.plans.runlog import RunLog, with_duration
from tierline.sources.lake import Lake

# Transport modes with reference frequencies and weights, chart labels.
MODES = [
    Mode("train_station_count", "train_freq_peak", "train_coverage", 6.0, 1.0),
    Mode("tram_stop_count", "tram_freq_peak", "tram_coverage", 10.0, 0.7),
    Mode("bus_stop_count", "bus_freq_peak", "bus_coverage", 6.0, 0.4),
]
MODE_LABELS = {"train_station_count": "Train", "tram_stop_count": "Tram", "bus_stop_count": "Bus"}
FACTORS = [
    Factor("Safety (low crime)", "offence_count_total", inverted=True),
    Factor("Schools (ICSEA)", "mean_icsea"),
    Factor("Transit", "connectivity_index"),
    Factor("Affordability", "median_house_price", inverted=True),
]

PLACE = ["suburb_name", "lga_code", "lga_name", "year"]
BANDS = ["pop_0_14", "pop_15_24", "pop_25_44", "pop_45_64", "pop_65_plus"]
PRICES = ["median_house_price", "median_unit_price", "median_rent_weekly"]


def _rows(lake: Lake, now: dict, subject: str) -> DataFrame:
    """A fact with its labels and years, one folder per year: built again when a table it is made from was published anew."""
    tables = [f"fact_{subject}", "dim_suburb_ref", "dim_lga_ref", "dim_year"]
    made_from = {t: now["gold", t].version for t in tables}

    def build() -> DataFrame:
        fact, suburbs, lgas, years = (lake.open(now["gold", t]) for t in tables)
        return reports.labelled(fact, suburbs, lgas, years, "suburb_ref_sk", ["sal_code", "suburb_name"], "lga_code", "lga_name")

    return lake.materialized("reporting", f"mart_{subject}", made_from, build, "year")


def _fact_years(lake: Lake, now: dict, subject: str) -> DataFrame:
    """Years a fact covers, whether or not its rows resolved: its partitions name them."""
    years = lake.open(now["gold", "dim_year"])
    used = lake.open(now["gold", f"fact_{subject}"]).select("year_sk").distinct()
    return years.join(used, "year_sk", "left_semi").select("year")


def views(lake: Lake) -> dict[str, DataFrame]:
    """The question views, each keeping ``sal_code`` so that later joins use the key."""
    now = lake.published()
    demo, transport, crime, edu, prop = (
        _rows(lake, now, s) for s in ("demographics", "transport", "crime", "education", "property")
    )
    key = ["sal_code", *PLACE]
    q5 = scoring.growth(prop, "sal_code", ["suburb_name", "lga_code", "lga_name"], "median_house_price")
    return {
        "vw_q1_population_growth": reports.trend(
            demo, key,
            ["population_total", "median_age", "median_household_income_weekly", *BANDS],
            ["population_total", "median_household_income_weekly"],
        ),
        "vw_q2_transport_connectivity": reports.connectivity(
            transport, key, MODES, _fact_years(lake, now, "transport")
        ).orderBy(F.col("connectivity_index").desc()),
        "vw_q3_low_crime": reports.trend(crime, key, ["offence_count_total"]).orderBy("suburb_name", "year"),
        "vw_q4_top_schools": reports.newest(
            edu, key, ["govt_school_count", "mean_icsea"], of=_fact_years(lake, now, "education")
        ).orderBy(F.col("mean_icsea").desc()),
        "vw_q5_affordable_growth": q5.orderBy(F.col("current_median").asc(), F.col("cagr_pct").desc()),
        "vw_q6_most_expensive": reports.trend(prop, key, PRICES, PRICES).orderBy("suburb_name", "year"),
    }


def datasets(v: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """What the charts bind to. Joins go by ``sal_code``: a renamed suburb stays one series."""
    q1, q2, q3 = v["vw_q1_population_growth"], v["vw_q2_transport_connectivity"], v["vw_q3_low_crime"]
    q4, q5, q6 = v["vw_q4_top_schools"], v["vw_q5_affordable_growth"], v["vw_q6_most_expensive"]
    place = ["suburb_name", "lga_name"]
    best = reports.all_round(
        q4.select("sal_code", *place, "mean_icsea"),
        [
            (scoring.newest_value(q3, "sal_code", "offence_count_total"), "offence_count_total"),
            (q2, "connectivity_index"),
            (scoring.newest_value(q6, "sal_code", "median_house_price"), "median_house_price"),
        ],
        "sal_code",
        place,
        FACTORS,
    )
    return {
        "ds_kpi": q1.select("sal_code", "lga_code", "year"),
        "ds_q1": q1.select(*place, "year", "population_total"),
        "ds_q3": q3.select(*place, "year", "offence_count_total"),
        "ds_q6": q6.select(*place, "year", "median_house_price"),
        "ds_q2": reports.modes_long(q2, place, MODE_LABELS),
        "ds_q4": reports.with_newest(q4, q1, "sal_code", "population_total").select(
            *place, "govt_school_count", "mean_icsea", "population_total"
        ),
        "ds_q5": reports.with_newest(q5, q1, "sal_code", "population_total").select(
            *place, "current_median", "cagr_pct", "population_total"
        ),
        "ds_best": best,
    }


def publish(lake: Lake) -> list[str]:
    """Create or replace the session's views; the plans read the tables current now."""
    made = []
    for name, df in views(lake).items():
        df.createOrReplaceTempView(name)
        made.append(name)
    health = with_duration(RunLog(lake).runs()).orderBy(F.col("started_at").desc())
    health.createOrReplaceTempView("vw_pipeline_health")
    return [*made, "vw_pipeline_health"]
