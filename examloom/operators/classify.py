"""Topics of questions by weighted keyword overlap with a syllabus, and merging two readings of a syllabus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TITLE_WEIGHT, LOW_CONFIDENCE, MOST_CONFIDENCE, LEAST_DENOMINATOR, GROWTH = 1.4, 0.12, 0.99, 8.0, 3.0
#: A taxonomy of at most so many rows of leaf and word is sent to all executors; a larger one is joined by shuffle.
BROADCAST_WORDS = 200_000
#: Scores that agree to so many places are tied: sums of floats depend on their order.
TIE_PLACES = 6

#: Words that say nothing about a topic.
STOP_WORDS = (
    "a an the and or of to in on for with from by is are be as at that this these those which what when where how why not no yes "
    "can may will would should could into using used use given following shown diagram figure table question answer option options "
    "correct statement about between each all both only same different one two three four most least more less than during after "
    "before under over per via such include includes including"
).split()

#: Weights of telling words; all others weigh 1.
BOOST = {
    "isotope": 3.0, "isotopes": 3.0, "nucleon": 3.0, "proton": 2.0, "neutron": 2.0, "electron": 1.5, "chromatography": 3.5,
    "distillation": 3.0, "filtration": 2.5, "crystallisation": 2.5, "crystallization": 2.5, "diffusion": 3.0, "ionic": 2.5,
    "covalent": 2.5, "metallic": 2.0, "mole": 3.0, "moles": 3.0, "stoichiometry": 3.0, "titration": 3.0, "acid": 2.0, "alkali": 2.5,
    "base": 1.5, "ph": 2.5, "redox": 3.5, "oxidation": 3.0, "reduction": 3.0, "oxidising": 3.0, "oxidizing": 3.0, "reducing": 3.0,
    "electrolysis": 3.5, "electrode": 2.5, "periodic": 2.5, "halogen": 3.0, "halogens": 3.0, "enthalpy": 3.5, "exothermic": 3.0,
    "endothermic": 3.0, "catalyst": 3.0, "rate": 1.5, "alkane": 3.0, "alkene": 3.0, "alcohol": 2.5, "carboxylic": 3.0, "polymer": 3.0,
    "cracking": 3.0, "fractional": 2.5, "atmosphere": 2.5, "pollutant": 3.0, "ozone": 3.0, "greenhouse": 3.0,
}


def tokens(text: Column) -> Column:
    """Lower-case runs of a-z and 0-9 of two characters or more that aren't stop words. A dotted capital I is an i, as in SQL, without a mark that parts the word."""
    found = F.regexp_extract_all(F.lower(F.replace(text, F.lit("İ"), F.lit("i"))), F.lit("([a-z0-9]+)"), F.lit(1))
    return F.filter(found, lambda t: (F.length(t) > 1) & ~t.isin(*STOP_WORDS))


def boost(token: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in BOOST.items() for x in pair]), token), F.lit(1.0))


def leaf_words(leaves: DataFrame) -> DataFrame:
    """(leaf, token, weight) of a taxonomy's leaves.

    ``leaves`` has leaf (position in the taxonomy), topic_title, section,
    title and outcomes, the last two null for topics without subtopics. Every
    occurrence counts; in a blob that reads like either title it counts 1.4
    times.
    """
    blob = F.explode(F.array("topic_title", "section", "title", "outcomes")).alias("blob")
    words = leaves.select("leaf", F.col("topic_title").alias("a"), F.col("title").alias("b"), blob).where(F.col("blob").isNotNull())
    titled = (F.col("blob") == F.col("a")) | F.coalesce(F.col("blob") == F.col("b"), F.lit(False))
    words = words.select("leaf", F.when(titled, TITLE_WEIGHT).otherwise(1.0).alias("times"), F.explode(tokens(F.col("blob"))).alias("token"))
    return words.groupBy("leaf", "token").agg(F.sum(boost(F.col("token")) * F.col("times")).alias("weight"))


def classify(questions: DataFrame, leaves: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per question the best leaf, its score, confidence and status (ok or needs_review).

    A shared token adds sqrt(occurrences) * weight in the leaf * boost. The
    first leaf in the taxonomy wins ties (``TIE_PLACES``). A question's tokens are made once and
    go one way: those that the taxonomy lacks are folded into one count before
    the first shuffle, which leaves a row for each question and known token.
    Questions without tokens or hits have no leaf, confidence 0 and need
    review. Ids are unique.
    """
    words = leaf_words(leaves)
    sent = F.broadcast if words.count() <= BROADCAST_WORDS else (lambda frame: frame)
    vocabulary = words.select("token", F.col("token").alias("known")).distinct()
    found = tokens(F.coalesce(F.col(text_col), F.lit("")))
    each = questions.select(id_col, found.alias("__tokens")).select(id_col, F.size("__tokens").alias("__n"), F.explode_outer("__tokens").alias("token"))
    counted = each.join(sent(vocabulary), "token", "left").groupBy(id_col, "__n", F.col("known").alias("token")).agg(F.count("*").alias("n"))
    hits = counted.join(sent(words), "token", "left")
    scores = hits.groupBy(id_col, "__n", "leaf").agg(F.sum(F.sqrt("n") * F.col("weight") * boost(F.col("token"))).alias("score"))
    place = F.when(F.col("leaf").isNotNull(), F.struct(F.round("score", TIE_PLACES).alias("tied"), (-F.col("leaf")).alias("first")))
    best = scores.groupBy(id_col, "__n").agg(F.max_by(F.struct("leaf", "score"), place).alias("best"))
    score = F.coalesce("best.score", F.lit(0.0))
    confidence = F.least(F.lit(MOST_CONFIDENCE), score / (score + F.greatest(F.lit(LEAST_DENOMINATOR), F.sqrt("__n") * GROWTH)))
    rows = best.select(id_col, F.col("best.leaf").alias("leaf"), score.alias("score"), confidence.alias("confidence"))
    return rows.withColumn("status", F.when(F.col("leaf").isNotNull() & (F.col("confidence") >= LOW_CONFIDENCE), "ok").otherwise("needs_review"))


def merge_readings(structure: DataFrame, detail: DataFrame, key: str = "number") -> DataFrame:
    """Topics of two readings of a syllabus: the longer title, the first section that isn't empty, the detail's subtopics if it has any."""
    s, d = structure.alias("s"), detail.alias("d")
    both = s.join(d, F.col(f"s.{key}") == F.col(f"d.{key}"), "full_outer")
    filled = lambda c: F.coalesce(c, F.lit("")) != ""
    longer = filled(F.col("d.title")) & (F.length("d.title") > F.coalesce(F.length("s.title"), F.lit(0)))
    return both.select(
        F.coalesce(f"s.{key}", f"d.{key}").alias(key),
        F.when(longer, F.col("d.title")).otherwise(F.coalesce("s.title", "d.title")).alias("title"),
        F.when(filled(F.col("s.section")), F.col("s.section")).otherwise(F.coalesce("d.section", "s.section")).alias("section"),
        F.when(F.size(F.coalesce("d.subtopics", F.array().cast("array<string>"))) > 0, F.col("d.subtopics")).otherwise(F.coalesce("s.subtopics", "d.subtopics")).alias("subtopics"),
    )


def code(paper_code: Column, leaf_code: Column) -> Column:
    """``6092:2.2``: the syllabus of a paper (what stands before ``/``, 6092 if nothing does) and the leaf."""
    return F.concat_ws(":", syllabus_of(paper_code), leaf_code)


def syllabus_of(paper_code: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(F.element_at(F.split(paper_code, "/"), 1)), F.lit("")), F.lit("6092"))


