"""Fixed catalogues of the health-statistics domain.

FIXED VALUES: the labels, codes and ids below must equal the published
catalogues for results to match; they are data, kept together in natural
order. Everything else in the library derives from these through Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# ---------------------------------------------------------------------------
# FIXED VALUES — selected countries: ISO2, ISO3, name, region (stage labels)
# ---------------------------------------------------------------------------
SELECTED_COUNTRIES = [
    ("GT", "GTM", "Guatemala", "Centroamérica"),
    ("HN", "HND", "Honduras", "Centroamérica"),
    ("SV", "SLV", "El Salvador", "Centroamérica"),
    ("NI", "NIC", "Nicaragua", "Centroamérica"),
    ("CR", "CRI", "Costa Rica", "Centroamérica"),
    ("PA", "PAN", "Panamá", "Centroamérica"),
    ("BZ", "BLZ", "Belice", "Centroamérica"),
    ("PE", "PER", "Perú", "América del Sur"),
    ("BO", "BOL", "Bolivia", "América del Sur"),
    ("EC", "ECU", "Ecuador", "América del Sur"),
    ("BR", "BRA", "Brasil", "América del Sur"),
    ("CO", "COL", "Colombia", "América del Sur"),
    ("AR", "ARG", "Argentina", "América del Sur"),
    ("CL", "CHL", "Chile", "América del Sur"),
    ("MX", "MEX", "México", "América del Norte"),
    ("US", "USA", "Estados Unidos", "América del Norte"),
    ("CA", "CAN", "Canadá", "América del Norte"),
    ("ES", "ESP", "España", "Europa"),
    ("IT", "ITA", "Italia", "Europa"),
    ("GB", "GBR", "Reino Unido", "Europa"),
    ("DE", "DEU", "Alemania", "Europa"),
    ("FR", "FRA", "Francia", "Europa"),
    ("SE", "SWE", "Suecia", "Europa"),
    ("PT", "PRT", "Portugal", "Europa"),
    ("RU", "RUS", "Rusia", "Europa"),
    ("UA", "UKR", "Ucrania", "Europa"),
    ("PL", "POL", "Polonia", "Europa"),
    ("JP", "JPN", "Japón", "Asia"),
    ("KR", "KOR", "Corea del Sur", "Asia"),
    ("TR", "TUR", "Turquía", "Asia"),
    ("AU", "AUS", "Australia", "Oceanía"),
    ("NZ", "NZL", "Nueva Zelanda", "Oceanía"),
]

# FIXED VALUES — warehouse region per ISO3 (dimension labels, unaccented)
DIM_REGION_BY_ISO3 = [
    ("GTM", "Centroamerica"), ("HND", "Centroamerica"), ("SLV", "Centroamerica"),
    ("NIC", "Centroamerica"), ("CRI", "Centroamerica"), ("PAN", "Centroamerica"),
    ("BLZ", "Centroamerica"), ("PER", "Sudamerica"), ("BRA", "Sudamerica"),
    ("COL", "Sudamerica"), ("ECU", "Sudamerica"), ("BOL", "Sudamerica"),
    ("ARG", "Sudamerica"), ("CHL", "Sudamerica"), ("USA", "Norteamerica"),
    ("MEX", "Norteamerica"), ("CAN", "Norteamerica"), ("ESP", "Europa"),
    ("ITA", "Europa"), ("SWE", "Europa"), ("GBR", "Europa"),
    ("DEU", "Europa"), ("FRA", "Europa"), ("PRT", "Europa"),
    ("RUS", "Europa"), ("UKR", "Europa"), ("POL", "Europa"),
    ("JPN", "Asia-Oceania"), ("KOR", "Asia-Oceania"), ("TUR", "Asia-Oceania"),
    ("AUS", "Asia-Oceania"), ("NZL", "Asia-Oceania"),
]

# FIXED VALUES — WHO region code → readable name; anything else → "Otro"
WHO_REGIONS = [
    ("AMRO", "América"),
    ("EURO", "Europa"),
    ("SEARO", "Asia Sudoriental"),
    ("WPRO", "Pacífico Occidental"),
    ("EMRO", "Mediterráneo Oriental"),
    ("AFRO", "África"),
    ("OTHER", "Otro"),
]
WHO_REGION_MISS = "Otro"

# FIXED VALUES — regional-annual source names → ISO3
REGIONAL_NAME_TO_ISO3 = [("Panama", "PAN"), ("Costa Rica", "CRI")]

# FIXED VALUES — ICD-10 chapter by first letter, stage wording (accented)
ICD_CHAPTERS_STAGE = [
    ("A", "Enfermedades infecciosas y parasitarias"),
    ("B", "Enfermedades infecciosas y parasitarias"),
    ("C", "Tumores / Neoplasias"),
    ("D", "Tumores / Enfermedades de la sangre"),
    ("E", "Enfermedades endocrinas y metabólicas"),
    ("F", "Trastornos mentales"),
    ("G", "Enfermedades del sistema nervioso"),
    ("H", "Enfermedades del ojo y oído"),
    ("I", "Enfermedades del sistema circulatorio"),
    ("J", "Enfermedades del sistema respiratorio"),
    ("K", "Enfermedades del sistema digestivo"),
    ("L", "Enfermedades de la piel"),
    ("M", "Enfermedades del sistema musculoesquelético"),
    ("N", "Enfermedades del sistema genitourinario"),
    ("O", "Embarazo, parto y puerperio"),
    ("P", "Afecciones del período perinatal"),
    ("Q", "Malformaciones congénitas"),
    ("R", "Síntomas y signos no clasificados"),
    ("S", "Traumatismos y envenenamientos"),
    ("T", "Traumatismos y envenenamientos"),
    ("U", "Códigos especiales (COVID-19)"),
    ("V", "Causas externas"),
    ("W", "Causas externas"),
    ("X", "Causas externas"),
    ("Y", "Causas externas"),
    ("Z", "Factores que influyen en el estado de salud"),
]
ICD_CHAPTER_STAGE_MISS = "Capítulo no identificado"

# FIXED VALUES — ICD-10 chapter by first letter, dimension wording (unaccented)
ICD_CHAPTERS_DIM = [
    ("A", "Enfermedades infecciosas y parasitarias"),
    ("B", "Enfermedades infecciosas y parasitarias"),
    ("C", "Tumores / Neoplasias"),
    ("D", "Tumores / Enfermedades de la sangre"),
    ("E", "Enfermedades endocrinas y metabolicas"),
    ("F", "Trastornos mentales"),
    ("G", "Enfermedades del sistema nervioso"),
    ("H", "Enfermedades del ojo y oido"),
    ("I", "Enfermedades del sistema circulatorio"),
    ("J", "Enfermedades del sistema respiratorio"),
    ("K", "Enfermedades del sistema digestivo"),
    ("L", "Enfermedades de la piel"),
    ("M", "Enfermedades del sistema musculoesqueletico"),
    ("N", "Enfermedades del sistema genitourinario"),
    ("O", "Embarazo, parto y puerperio"),
    ("P", "Afecciones del periodo perinatal"),
    ("Q", "Malformaciones congenitas"),
    ("R", "Sintomas y signos no clasificados"),
    ("S", "Traumatismos y envenenamientos"),
    ("T", "Traumatismos y envenenamientos"),
    ("U", "Codigos especiales (COVID-19)"),
    ("V", "Causas externas"),
    ("W", "Causas externas"),
    ("X", "Causas externas"),
    ("Y", "Causas externas"),
    ("Z", "Factores que influyen en el estado de salud"),
]
ICD_CHAPTER_DIM_MISS = "No especificado"

# FIXED VALUES — ICD-10 category by first letter; anything else → "Otra"
ICD_CATEGORIES = [
    ("A", "Infecciosa"), ("B", "Infecciosa"), ("C", "Cronica"), ("D", "Cronica"),
    ("E", "Cronica"), ("F", "Cronica"), ("G", "Cronica"), ("H", "Cronica"),
    ("I", "Cronica"), ("J", "Cronica"), ("K", "Cronica"), ("L", "Cronica"),
    ("M", "Cronica"), ("N", "Cronica"), ("O", "Materna"), ("P", "Perinatal"),
    ("Q", "Congenita"), ("R", "Otra"), ("S", "Externa"), ("T", "Externa"),
    ("U", "COVID-19"), ("V", "Externa"), ("W", "Externa"), ("X", "Externa"),
    ("Y", "Externa"), ("Z", "Otra"),
]
ICD_CATEGORY_MISS = "Otra"

# FIXED VALUES — seed causes appended to the cause dimension
SEED_CAUSES = [
    ("U071", "COVID-19 identificado"),
    ("ZGEN", "Mortalidad general sin causa especifica"),
]

# FIXED VALUES — sex dimension (id, code, label) and label → id map
DIM_SEX = [(1, "F", "Femenino"), (2, "M", "Masculino"), (3, "N", "No especificado")]
SEX_LABEL_TO_ID = [("Mujer", 1), ("Femenino", 1), ("Hombre", 2), ("Masculino", 2)]
SEX_ID_MISS = 3
SEX_CODE_TO_LABEL = [("F", "Femenino"), ("M", "Masculino")]
SEX_MISS = "No especificado"

# FIXED VALUES — age-group dimension (id, label, min, max)
DIM_AGE_GROUP = [
    (1, "< 1 anio", 0, 0),
    (2, "1-4", 1, 4),
    (3, "5-14", 5, 14),
    (4, "15-29", 15, 29),
    (5, "30-44", 30, 44),
    (6, "45-59", 45, 59),
    (7, "60 o mas", 60, None),
    (8, "No especificado", None, None),
]
AGE_GROUP_ID_MISS = 8

# FIXED VALUES — stage age-band labels (band lower bounds) and stage → dim label map
STAGE_AGE_BANDS = [(1, "< 1 año"), (5, "1-4"), (15, "5-14"), (30, "15-29"),
                   (45, "30-44"), (60, "45-59")]
STAGE_AGE_TOP = "60+"
DIM_AGE_BANDS = [(1, "< 1 anio"), (5, "1-4"), (15, "5-14"), (30, "15-29"),
                 (45, "30-44"), (60, "45-59")]
DIM_AGE_TOP = "60 o mas"
AGE_LABEL_STAGE_TO_DIM = [
    ("< 1 año", "< 1 anio"), ("1-4", "1-4"), ("5-14", "5-14"), ("15-29", "15-29"),
    ("30-44", "30-44"), ("45-59", "45-59"), ("60+", "60 o mas"),
    ("No especificado", "No especificado"),
]
AGE_MISS = "No especificado"

# FIXED VALUES — source dimension (id, name, kind, coverage country, coverage years)
DIM_SOURCE = [
    (1, "INE", "Nacional", "Guatemala", "2018-2024"),
    (2, "MSPAS_MEC", "Institucional", "Guatemala", "2012-2024"),
    (3, "MSPAS_COVID", "Institucional", "Guatemala", "2020-2024"),
    (4, "WORLD_MORTALITY", "Internacional", "Global", "2015-2024"),
    (5, "CENTROAMERICA_RDS", "Internacional", "Centroamerica", "2000-2023"),
    (6, "OMS_COVID_MUNDIAL", "Internacional", "Global", "2020-2024"),
]

# FIXED VALUES — source tags written by the stage jobs and the regional loaders
STAGE_TAG_DEATHS = "INE_STAGE"
STAGE_TAG_CASES = "MSPAS_MEC_STAGE"
STAGE_TAG_COVID_LOCAL = "MSPAS_COVID_STAGE"
STAGE_TAG_COVID_WORLD = "OMS_COVID_MUNDIAL_STAGE"
STAGE_TAG_WORLD = "WORLD_MORTALITY"
REGIONAL_SOURCES = [("Panama", "CONTRALORIA_PANAMA"), ("Costa Rica", "INEC_COSTA_RICA")]
REGIONAL_REGION = "Centroamérica"

# FIXED VALUES — constants of the national geography dimension
GEO_COUNTRY, GEO_ISO3, GEO_VALID_FROM = "Guatemala", "GTM", "2015-01-01"

# FIXED VALUES — default labels of the cleaning rules
NULL_CODE_LABEL = "Ignorado / No especificado"
MISSING_CODE_PREFIX = "Código no encontrado: "
CAUSE_MISS = "Sin descripción en catálogo"
CAUSE_DIM_MISS = "Sin descripcion"
GEO_MISS = "Ignorado"
REGION_MISS = "Sin región"
PERIOD_PRE, PERIOD_COVID, PERIOD_POST, PERIOD_UNKNOWN = "pre-COVID", "COVID", "post-COVID", "Ignorado"
EXCESS_THRESHOLD = 0.15
SWEEP_THRESHOLDS = [0.40, 0.45, 0.50, 0.55, 0.60, 0.65, 0.70, 0.75]


def frame(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A catalogue as a small DataFrame (size fixed by code → safe to broadcast)."""
    return spark.createDataFrame(list(rows), schema=schema)


def countries_df(spark: SparkSession) -> DataFrame:
    return frame(spark, SELECTED_COUNTRIES, "iso2 string, iso3 string, country string, region string")


def age_group_df(spark: SparkSession) -> DataFrame:
    return frame(spark, DIM_AGE_GROUP, "id_grupo_etario int, rango string, edad_min int, edad_max int")


def sex_df(spark: SparkSession) -> DataFrame:
    return frame(spark, DIM_SEX, "id_sexo int, codigo string, descripcion string")


def source_df(spark: SparkSession) -> DataFrame:
    return frame(spark, DIM_SOURCE,
                 "id_fuente int, nombre string, tipo string, pais_cobertura string, cobertura_temporal string")

