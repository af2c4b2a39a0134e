"""Language registry and code maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.schemas import LANGUAGES

# Code, name, tier (h: high), short code, script, code of the translation model.
REGISTRY = """
eng English h en Latn eng_Latn
spa Spanish h es Latn spa_Latn
fra French h fr Latn fra_Latn
deu German h de Latn deu_Latn
por Portuguese h pt Latn por_Latn
rus Russian h ru Cyrl rus_Cyrl
zho Chinese h zh Hans zho_Hans
jpn Japanese h ja Jpan jpn_Jpan
kor Korean h ko Kore kor_Hang
ita Italian h it Latn ita_Latn
nld Dutch h nl Latn nld_Latn
pol Polish h pl Latn pol_Latn
tur Turkish h tr Latn tur_Latn
ces Czech h cs Latn ces_Latn
swe Swedish h sv Latn swe_Latn
ukr Ukrainian h uk Cyrl ukr_Cyrl
ron Romanian h ro Latn ron_Latn
ara Arabic h ar Arab arb_Arab
hin Hindi n hi Deva hin_Deva
ben Bengali n bn Beng ben_Beng
nep Nepali n ne Deva npi_Deva
swa Swahili n sw Latn swh_Latn
amh Amharic n am Ethi amh_Ethi
orm Afaan_Oromo n om Latn gaz_Latn
hau Hausa n ha Latn hau_Latn
yor Yoruba n yo Latn yor_Latn
ibo Igbo n ig Latn ibo_Latn
tgl Tagalog n tl Latn tgl_Latn
mya Burmese n my Mymr mya_Mymr
khm Khmer n km Khmr khm_Khmr
kin Kinyarwanda n rw Latn kin_Latn
som Somali n so Latn som_Latn
tir Tigrinya n ti Ethi tir_Ethi
"""


def rows() -> list[tuple[str, str, str, str, str, str, None]]:
    cut = [line.split() for line in REGISTRY.strip().splitlines()]
    return [(c, n.replace("_", " "), "high" if t == "h" else "non_high", b, s, m, None) for c, n, t, b, s, m in cut]


def registry(spark: SparkSession, table: DataFrame | None = None) -> DataFrame:
    """The dimension of 33 rows, or a caller's own of the same columns."""
    return table if table is not None else spark.createDataFrame(rows(), LANGUAGES)


def lookup(code: Column, of: dict[str, str]) -> Column:
    """A small map as a literal; unknown codes pass through."""
    pairs = [F.lit(x) for kv in of.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[code], code)


SHORT = {r[0]: r[3] for r in rows()}
ISO3 = {r[3]: r[0] for r in rows()}
WHISPER = {r[0]: r[3] for r in rows() if r[2] == "high"}


def tag(code: Column) -> Column:
    return lookup(code, SHORT)


def iso3(short: Column) -> Column:
    return lookup(short, ISO3)


def whisper_code(code: Column) -> Column:
    return lookup(code, WHISPER)


def full_name(code: Column, names: dict[str, str] | None = None) -> Column:
    """Lower-case English name; names adds languages that the registry lacks."""
    return lookup(code, {r[0]: r[1].lower() for r in rows()} | (names or {}))


def with_language(df: DataFrame, spark_registry: DataFrame, code_col: str = "language", broadcast_rows: int = 10_000) -> DataFrame:
    """df with its language's attributes; an unknown code gets defaults. A registry of up to broadcast_rows is broadcast."""
    lang = spark_registry.select(F.col("code").alias("_code"), *[F.col(c).alias(f"_{c}") for c in ("name", "tier", "bcp47", "script", "nllb_code")])
    code = F.col(code_col)
    small = lang.limit(broadcast_rows + 1).count() <= broadcast_rows
    out = df.join(F.broadcast(lang) if small else lang, code == F.col("_code"), "left")
    return out.select(
        *[F.col(c) for c in df.columns],
        F.coalesce("_name", F.concat(F.lit("Unknown ("), code, F.lit(")"))).alias("language_name"),
        F.coalesce("_tier", F.lit("non_high")).alias("tier"),
        F.coalesce("_bcp47", code).alias("bcp47"),
        F.coalesce("_script", F.lit("Latn")).alias("script"),
        F.coalesce("_nllb_code", F.concat(code, F.lit("_Latn"))).alias("nllb_code"),
        (code == "eng").alias("is_english"),
        F.coalesce(F.col("_tier") == "high", F.lit(False)).alias("is_high"),
    )


def engine_for(tier: Column, forced: str | None = None, default: str = "omnilingual", high: str = "whisper") -> Column:
    return F.when(tier == "high", high).otherwise(F.coalesce(F.lit(forced), F.lit(default)))


def model_language(code: Column, script: Column) -> Column:
    return F.concat_ws("_", code, F.coalesce(script, F.lit("Latn")))


def with_default_script(code: Column) -> Column:
    return F.when(code.contains("_"), code).otherwise(F.concat(code, F.lit("_Latn")))


def without_script(code: Column) -> Column:
    return F.split_part(code, F.lit("_"), F.lit(1))


def is_prefixed_model(model: Column, prefixes: tuple[str, ...] = ("omniASR_CTC_", "omniASR_LLM_")) -> Column:
    found = F.lit(False)
    for p in prefixes:
        found |= model.startswith(p)
    return found


def is_ctc_model(model: Column) -> Column:
    return F.upper(model).contains("CTC")


def language_mix(probabilities: Column, gap: float = 0.3) -> Column:
    """(language, probability, mixed) of an array of (language, probability): mixed if the first two are close."""
    by = F.array_sort(probabilities, lambda a, b: F.when(a["probability"] > b["probability"], -1).when(a["probability"] < b["probability"], 1).otherwise(0))
    first, second = F.try_element_at(by, F.lit(1)), F.try_element_at(by, F.lit(2))
    return F.struct(
        F.coalesce(first["language"], F.lit("eng")).alias("language"),
        F.coalesce(first["probability"], F.lit(0.0)).alias("probability"),
        F.coalesce(first["probability"] - second["probability"] < gap, F.lit(False)).alias("mixed"),
    )


def confidence(avg_logprob: Column) -> Column:
    """exp of a mean log-probability, held between 0 and 1; 0 where it is 0 or missing."""
    held = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.exp(avg_logprob)))
    return F.when(avg_logprob.isNull() | (avg_logprob == 0), 0.0).otherwise(held)
