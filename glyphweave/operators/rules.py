"""The rule ledger: which characters are kept, transformed and deleted, as data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.unicode import is_numeric

# Fixed values of the ledger.
KEEP = (
    0x0623, 0x0624, 0x0626, 0x0627, 0x0628, 0x0629, 0x062A, 0x062B, 0x062C, 0x062D, 0x062E, 0x062F, 0x0630,
    0x0631, 0x0632, 0x0633, 0x0634, 0x0635, 0x0636, 0x0637, 0x0638, 0x0639, 0x063A, 0x0641, 0x0642, 0x0643,
    0x0644, 0x0645, 0x0646, 0x0647, 0x0648, 0x064A, 0x064B, 0x064C, 0x064D, 0x064E, 0x064F, 0x0650, 0x0652,
    0x0654, 0x0656, 0x06E1, 0x06E9, 0x0020, 0x00A0, 0x0655, 0x200C, 0x200D, 0x200E, 0x200F,
)
TRANSFORM = {
    0x0621: 0x0627, 0x0625: 0x0627, 0x0649: 0x0627, 0x0653: 0x0627, 0x0657: 0x0627, 0x0670: 0x0627, 0x06E4: 0x0627,
    0x06E6: 0x064A, 0x06E7: 0x064A, 0x06ED: 0x0645, 0x0671: 0x0627, 0x0622: 0x0627, 0x06E3: 0x062B,
}
DELETE = (
    0x0651, 0x065E, 0x06D6, 0x06D7, 0x06D8, 0x06DA, 0x06DB, 0x06DC, 0x06DE, 0x06E0, 0x06E2, 0x06E5, 0x06EC, 0x0031,
    0x0034, 0x0035, 0x0660, 0x0661, 0x0662, 0x0663, 0x0664, 0x0665, 0x0666, 0x0667, 0x0668, 0x0669, 0x002D, 0x003A,
    0x0640, 0x06EB, 0x06D4, 0x06DD, 0xFDFD, 0xFDFB,
)
DELETE_SEQUENCES = ((0x0644, 0x0627), (0x0642, 0x0644, 0x064A), (0x0635, 0x0644, 0x064A))
OVERRIDES = {0x065E: 0x064C, 0x06CC: 0x064A}
CONTEXTUAL = (0x0653, 0x0657, 0x06E4)
ADDED_DELETE, GUARDED_DELETE = 0xFDFA, 0xFDFD
SEPARATORS = (0x002D, 0x003A, 0x06DE, 0x06D4, 0x06DD, 0xFDFA, 0xFDFB, 0xFDFD)
SPECIAL = (0x0653, 0x0657, 0x065E, 0x0670, 0x06E4, 0xFDFD, 0xFDFA, 0xFDFB, 0x06CC)
LONG_VOWELS = (0x0627, 0x0648, 0x064A)
INITIAL_FORMS = ("الم", "المص", "الر", "المر", "كهيعص", "طه", "طسم", "طس", "يس", "ص", "حم", "حم عسق", "عسق", "ق", "ن")
BISMILLAH_SKELETONS = ("بسمٱللهٱلرحمنٱلرحيم", "بسماللهالرحمنالرحيم")
# End of fixed values.

SIMPLE = {k: v for k, v in TRANSFORM.items() if k not in CONTEXTUAL} | OVERRIDES
EFFECTIVE_DELETE = tuple(sorted({*DELETE, ADDED_DELETE} - {*OVERRIDES, GUARDED_DELETE}))
KNOWN = tuple(sorted({*KEEP, *TRANSFORM, *OVERRIDES, *EFFECTIVE_DELETE}))
TRIGGERS = tuple(sorted({*TRANSFORM, *OVERRIDES, *EFFECTIVE_DELETE, GUARDED_DELETE}))

SCHEMA = "source array<int>, action string, target array<int>, label string"


def label(source: tuple[int, ...], target: tuple[int, ...] = ()) -> str:
    return "+".join(f"U+{c:04X}" for c in source) + "".join(f"->U+{c:04X}" for c in target)


def ledger_rows() -> list[tuple]:
    rows = [([c], "KEEP", [], label((c,))) for c in KEEP]
    rows += [([c], "TRANSFORM", [t], label((c,), (t,))) for c, t in TRANSFORM.items()]
    rows += [([c], "DELETE", [], label((c,))) for c in DELETE]
    return rows + [(list(s), "DELETE", [], label(s)) for s in DELETE_SEQUENCES]


def ledger(spark: SparkSession) -> DataFrame:
    """The 100 rules as a table."""
    return spark.createDataFrame(ledger_rows(), SCHEMA)


def action_counts(spark: SparkSession) -> DataFrame:
    return ledger(spark).groupBy("action").agg(F.count("*").alias("n_rules"))


def effective_actions(rules: DataFrame) -> DataFrame:
    """Each source with the action and target that hold: a sequence is guarded by its context, then come overrides,
    the guarded ligature, transforms (contextual or plain), kept and deleted characters."""
    cp = F.col("source")[0]
    override = F.element_at(F.create_map(*(F.lit(x) for pair in OVERRIDES.items() for x in pair)), cp)
    rank = F.when(F.col("action") == "TRANSFORM", 0).when(F.col("action") == "KEEP", 1).otherwise(2)
    added = rules.sparkSession.createDataFrame([([c], "DELETE", [], label((c,))) for c in (ADDED_DELETE, *(set(OVERRIDES) - set(TRANSFORM) - set(DELETE)))], SCHEMA)
    first = rules.unionByName(added).withColumn("rank", rank).groupBy("source").agg(F.min_by(F.struct("action", "target"), "rank").alias("r"))
    guarded = (F.size("source") > 1) | (cp == GUARDED_DELETE)
    action = (
        F.when(guarded, "CONTEXT_GUARDED_DELETE").when(override.isNotNull(), "TRANSFORM")
        .when((F.col("r.action") == "TRANSFORM") & cp.isin(*CONTEXTUAL), "CONTEXTUAL_TRANSFORM").otherwise(F.col("r.action"))
    )
    target = F.when(guarded, F.array().cast("array<int>")).when(override.isNotNull(), F.array(override)).when(F.col("r.action") == "KEEP", F.col("source")).otherwise(F.col("r.target"))
    return first.select("source", action.alias("action"), target.alias("target"))


def rule_labels(spark: SparkSession) -> DataFrame:
    """All labels, those of effective rules included."""
    extra = spark.createDataFrame([("E2_U+06CC_to_U+064A",), ("E4_U+FDFA_delete",), ("E3_numeric_category",)], "label string")
    return ledger(spark).select("label").union(extra).distinct()


#: Labels of the two effective rules that are no single code point of the ledger's transforms and deletes.
NUMERIC_LABEL, GUARDED_LABEL = "E3:Unicode numeric category", f"U+{GUARDED_DELETE:04X}"


def matchable_labels(spark: SparkSession) -> DataFrame:
    """(label): effective rules that a text can match."""
    points = {*TRANSFORM, *OVERRIDES, *EFFECTIVE_DELETE}
    labels = {*(label((c,)) for c in points), *(label(s) for s in DELETE_SEQUENCES), NUMERIC_LABEL, GUARDED_LABEL}
    return spark.createDataFrame([(x,) for x in sorted(labels)], "label string")


def is_deleted(ch: Column) -> Column:
    return F.ascii(ch).isin(*EFFECTIVE_DELETE) | is_numeric(ch)


def is_separator(ch: Column) -> Column:
    return F.ascii(ch).isin(*SEPARATORS) | is_numeric(ch)


def is_known(ch: Column) -> Column:
    return F.ascii(ch).isin(*KNOWN) | is_numeric(ch)


def is_trigger(ch: Column) -> Column:
    return F.ascii(ch).isin(*TRIGGERS) | is_numeric(ch)
