"""End-to-end warehouse run: sandbox → stage → dw → marts, one written layer at a time.

Every layer is a set of Parquet tables under ``<root>/<layer>/<table>``
(versioned, see ``sources.layers``), so each step reads the previous layer
with column pruning, a failed step can be re-run alone, and executor loss
never recomputes earlier layers.

    python -m vitals --sf-dir /root/testdata/sf0.01 [--root <shared folder>] [--steps sandbox,stage,dw,marts]
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vitals import adapter as A
from vitals.plans import dims as D
from vitals.plans import facts as H
from vitals.plans import load as L
from vitals.plans import marts as M
from vitals.plans import stage as S
from vitals.plans.sandbox import jobs, write_sources
from vitals.session import scratch_path
from vitals.sources import layers

STEPS = ("sandbox", "stage", "dw", "marts")


def run_sandbox(spark: SparkSession, folder: str, root: str) -> DataFrame:
    """The landing jobs of all sources over a folder of files."""
    return jobs(folder).run(spark, root, layer="sandbox")


def _sb(spark: SparkSession, root: str, name: str) -> DataFrame:
    return layers.read_table(spark, root, "sandbox", name)


def run_stage(spark: SparkSession, root: str, covid_start: int, covid_end: int,
              years: tuple[int, int]) -> dict[str, int]:
    t = {
        "stage_defunciones_gt": S.stage_deaths(
            _sb(spark, root, "sandbox_ine"), _sb(spark, root, "sandbox_ine_diccionario"),
            S.icd_catalogue(_sb(spark, root, "sandbox_ine_cie10")), covid_start, covid_end),
        "stage_mspas_mec": S.stage_cases(_sb(spark, root, "sandbox_mspas_mec"), years=years,
                                         covid_start=covid_start, covid_end=covid_end),
        "stage_mspas_covid": S.stage_covid_local(_sb(spark, root, "sandbox_mspas_covid"), years=years,
                                                 covid_end=covid_end),
        "stage_mortalidad_mundial": S.stage_mortality_world(
            _sb(spark, root, "sandbox_world_mortality"), _sb(spark, root, "sandbox_centroamerica"),
            min_year=years[0], covid_start=covid_start, covid_end=covid_end),
        "stage_covid_mundial": S.stage_covid_world(_sb(spark, root, "sandbox_covid_mundial"),
                                                   covid_start, covid_end),
    }
    out, at = {}, L.run_timestamp()
    for name, df in t.items():
        layers.write_replace(S.loaded(df, at), root, "stage", name)
        out[name] = layers.read_table(spark, root, "stage", name).count()
    return out


def _st(spark: SparkSession, root: str, name: str) -> DataFrame:
    return layers.read_table(spark, root, "stage", name)


def run_dw(spark: SparkSession, root: str, covid_start: int, covid_end: int, min_year_cases: int) -> DataFrame:
    """Dimensions (insert-if-absent, fixed order), then the five facts (replace)."""
    sd, sc = _st(spark, root, "stage_defunciones_gt"), _st(spark, root, "stage_mspas_mec")
    cl, mw = _st(spark, root, "stage_mspas_covid"), _st(spark, root, "stage_mortalidad_mundial")
    cw = _st(spark, root, "stage_covid_mundial")
    static = D.dim_static(spark)
    built = {
        "dim_tiempo": (D.dim_time(D.time_members(cases=sc, covid_local=cl, deaths=sd, world=mw, covid_world=cw),
                                  covid_start, covid_end, numbered=False), ["anio", "mes"], "id_tiempo", False),
        "dim_geografia_gt": (D.dim_geo(D.geo_members(deaths=sd, cases=sc, covid_local=cl), numbered=False),
                             ["nombre_departamento", "nombre_municipio"], "id_geografia", False),
        "dim_geografia_mundial": (D.dim_country(world=mw, covid_world=cw, numbered=False), ["iso3c"], "id_pais", False),
        "dim_causa_cie10": (D.dim_cause(spark, cases=sc, deaths=sd, numbered=False), ["codigo_cie10"], "id_causa", False),
        "dim_sexo": (static["dim_sexo"], ["codigo"], "id_sexo", True),
        "dim_grupo_etario": (static["dim_grupo_etario"], ["rango"], "id_grupo_etario", True),
        "dim_fuente": (static["dim_fuente"], ["nombre"], "id_fuente", True),
    }
    report = L.load_dimensions(spark, root, built)

    def dim(name):
        return layers.read_table(spark, root, "dw", name)

    t, g, c = dim("dim_tiempo"), dim("dim_geografia_gt"), dim("dim_causa_cie10")
    p = dim("dim_geografia_mundial")
    age, src = dim("dim_grupo_etario"), dim("dim_fuente")
    loaded_at = L.run_timestamp()
    facts = {
        "fact_defunciones_gt": (H.fact_deaths(sd, t, g, c, age, src), "id_defuncion"),
        "fact_morbimortalidad_mec": (H.fact_cases(sc, t, g, c, age, min_year=min_year_cases), "id_fact"),
        "fact_mortalidad_covid_gt": (H.fact_covid_local(cl, t, g, c, src), "id_fact"),
        "fact_mortalidad_mundial": (H.fact_mortality_world(mw, t, p), "id_fact"),
        "fact_covid_mundial": (H.fact_covid_world(cw, t, p), "id_fact"),
    }
    rows = []
    for name, (fb, id_col) in facts.items():
        fact = fb.fact
        loaded = L.load_fact(fact, root, name, id_col, loaded_at=loaded_at)
        rows.append((name, loaded.count()))
    facts_report = spark.createDataFrame(rows, "dimension string, filas_despues bigint")
    return report.unionByName(facts_report, allowMissingColumns=True)


def run_marts(spark: SparkSession, root: str, years: tuple[int, int],
              baseline_years: tuple[int, int]) -> dict[str, int]:
    """Monthly observed series from the star, baseline and excess label."""
    fact = layers.read_table(spark, root, "dw", "fact_defunciones_gt")
    t = layers.read_table(spark, root, "dw", "dim_tiempo")
    g = layers.read_table(spark, root, "dw", "dim_geografia_gt")
    observed = M.star_observed(fact, t, g, years=years)
    layers.write_replace(observed, root, "marts", "muertes_mensuales")
    observed = layers.read_table(spark, root, "marts", "muertes_mensuales")
    labelled = M.excess_one_pass(observed, years=baseline_years)
    layers.write_replace(labelled, root, "marts", "exceso_mortalidad")
    return {"muertes_mensuales": observed.count(),
            "exceso_mortalidad": layers.read_table(spark, root, "marts", "exceso_mortalidad").count()}


def run(spark: SparkSession, sf_dir: str, root: str, steps=STEPS, covid_start: int = A.TEST_COVID_START,
        covid_end: int = A.TEST_COVID_END, years: tuple[int, int] = (1996, 2001),
        baseline_years: tuple[int, int] = A.TEST_BASELINE_YEARS, files: str | None = None) -> dict:
    """Run the selected steps in order; returns each step's report. ``files``: the folder
    of source files (``plans.sandbox``); by default one is laid down from ``sf_dir``."""
    out = {}
    if "sandbox" in steps:
        if files is None:
            files = scratch_path(spark, "source-files")
            write_sources(spark, sf_dir, files)
        report = run_sandbox(spark, files, root)
        out["sandbox"] = [r.asDict() for r in report.collect()]
        out["sandbox_summary"] = layers.run_summary(report).first().asDict()
    if "stage" in steps:
        out["stage"] = run_stage(spark, root, covid_start, covid_end, years)
    if "dw" in steps:
        out["dw"] = [r.asDict() for r in run_dw(spark, root, covid_start, covid_end, years[0] + 1).collect()]
    if "marts" in steps:
        out["marts"] = run_marts(spark, root, A.TEST_YEARS, baseline_years)
    return out

