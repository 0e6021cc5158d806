"""The layered pipeline end to end: its mart equals the star query, and a re-run of the
dimension step changes nothing."""

import __spark_entry__ as E
from vitals import adapter as A
from vitals.plans import stage as S
from vitals.plans.pipeline import run
from vitals.session import scratch_path
from vitals.sources import layers


def test_pipeline_end_to_end(spark, sf_small):
    root = scratch_path(spark, "wh-test")
    rep = run(spark, sf_small, root)
    assert all(r["estado"] == "ok" for r in rep["sandbox"]), rep["sandbox"]
    lost = layers.read_table(spark, root, "sandbox", "sandbox_ine_rechazos")
    assert {r.motivo for r in lost.select("motivo").distinct().collect()} <= {"html", "cabecera"} and not lost.isEmpty()
    # what went through files equals what the sources hold, row by row
    args = {"covid_start": A.TEST_COVID_START, "covid_end": A.TEST_COVID_END}
    years = (1996, 2001)
    want = {
        "stage_defunciones_gt": S.stage_deaths(A.deaths_raw(spark, sf_small), A.ine_dictionary(spark, sf_small),
                                               S.icd_catalogue(A.icd_catalogue_raw(spark, sf_small)), **args),
        "stage_mspas_mec": S.stage_cases(A.cases_raw(spark, sf_small), years=years, **args),
        "stage_mspas_covid": S.stage_covid_local(A.covid_local_long(spark, sf_small), years=years, covid_end=args["covid_end"]),
        "stage_mortalidad_mundial": S.stage_mortality_world(
            A.world_mortality(spark, sf_small), S.homologate_regional(A.regional_panama(spark, sf_small), A.regional_costa_rica(spark, sf_small)),
            min_year=years[0], **args),
        "stage_covid_mundial": S.stage_covid_world(A.covid_world_weekly(spark, sf_small), **args),
    }
    for name, rows in want.items():
        got = layers.read_table(spark, root, "stage", name)
        assert got.select(*rows.columns).exceptAll(rows).isEmpty() and rows.exceptAll(got.select(*rows.columns)).isEmpty(), name
        assert got.where(f"{S.LOADED} IS NULL").isEmpty()
        assert name == "stage_covid_mundial" or got.where(f"{S.FILE} IS NULL").isEmpty(), name
    assert rep["stage"]["stage_defunciones_gt"] > 0
    mart = layers.read_table(spark, root, "marts", "muertes_mensuales")
    star = E.queries()["star_observed"](spark, sf_small)
    assert sorted(tuple(r) for r in mart.select(*star.columns).collect()) == sorted(tuple(r) for r in star.collect())
    again = run(spark, sf_small, root, steps=["dw"])["dw"]
    dims = [r for r in again if r.get("ids_cambiados") is not None]
    assert dims and all(r["ids_cambiados"] == 0 and r["filas_antes"] == r["filas_despues"] for r in dims)
