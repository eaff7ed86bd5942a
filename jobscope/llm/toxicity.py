"""Toxicity: gradient-boosted trees over dense text features, calibrated by isotonic regression.

Features are Spark column expressions over the whole text: densities of fixed word
lists (insults, vulgar words, threats, and the same in German, French and
Spanish) and of learned lexicons, hits near a second-person word, capitals, punctuation, and hits that
only show after undoing character swaps.

The lexicons are learned from the labelled texts of folds 0 and 1 (crc32 of the id as text modulo 4): whole
words and word beginnings of 4 to 7 letters, kept when the lower confidence bound of their log-odds between toxic and
other texts is high enough (two tiers), at most ``LEXICON`` entries a tier. The trees are fitted on the same folds, but a text of one fold is
seen through the lexicon of the other, so no text vouches for its own words; scoring
uses the lexicon of both. The calibration is fitted on fold 3, and fold 2 is never learned from. All fits together
use at most about ``fit_rows`` labelled rows, chosen by a hash of the id, whose texts are picked out once; the
language of a text is never read.

Defined results: a null or empty text has all features 0 and gets the score
the model gives to that; a null id or label is not learned from; with fewer
than one row of either class the score is the share of label 1 (0 without
labels); entries that tie at the end of a lexicon are taken in alphabetical order; repeated rows
are scored each; only id and text are read, labels by id.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobscope.llm.common import discard, fold, fresh, held_out, let, sampled, written

# Word lists.
INSULTS = ("idiot idiots idiotic moron morons moronic stupid clown clowns loser losers scum trash garbage pathetic "
           "worthless disgusting dumb dumbass imbecile fool fools freak creep pig pigs rat vermin filth filthy ugly "
           "coward jerk brainless retard retarded degenerate parasite parasites subhuman lowlife").split()
VULGAR = "fuck fucking fucked fucker shit shitty bullshit bitch bitches bastard asshole ass crap damn dick piss slut whore".split()
THREATS = "kill die hate hurt destroy burn hang shoot beat rape stab choke exterminate".split()
OTHER_LANGUAGES = ("dumm dummkopf idioten arschloch scheisse scheiße abschaum müll trottel widerlich wertlos versager hurensohn "
                   "imbécile idiote connard salope merde ordure minable crétin débile pourriture dégoûtant "
                   "idiota estúpido estúpida imbécil basura escoria patético inútil asqueroso puta mierda cabrón").split()
YOU = ("you your yours yourself u ya du dich dir dein deine ihr euch tu te toi vous votre ton ta tes "
       "tú ti tus usted ustedes vosotros").split()
FEATURES = ("insults", "vulgar", "threats", "others", "near_you", "hidden", "distinct", "capitals", "shouted",
            "exclaims", "repeated_marks", "odd_words", "long_runs", "log_words", "strong", "strong_kinds", "weak", "weak_kinds",
            "strong_near_you")
#: Learned lexicons: entries a tier, rows an entry has to occur in, and the least log-odds (lower bound) of the tiers.
LEXICON, MIN_ROWS, STRONG, WEAK = 400, 4, 1.5, 0.7
PREFIXES = (4, 5, 6, 7)


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+"), "")


def entries(text: Column) -> Column:
    """Distinct words of a text and, marked with a star, their beginnings of 4 to 7 letters."""
    def of(w: Column) -> Column:
        heads = [F.when(F.length(w) >= k, F.concat(F.substring(w, 1, k), F.lit("*"))) for k in PREFIXES]
        return F.array_compact(F.array(w, *heads))

    return F.array_distinct(F.flatten(F.transform(F.array_distinct(_words(text)), of)))


def learn_lexicons(rows: DataFrame) -> list[tuple[list[str], list[str]]]:
    """(strong, weak) entries learned from fold 0, from fold 1, and from both; ``rows`` has part, label and text."""
    seen = rows.where("part in (0, 1)")
    size = {(r["part"], int(r["label"])): r["count"] for r in seen.groupBy("part", "label").count().collect()}
    counts = seen.select("part", "label", F.explode(entries(F.col("text"))).alias("entry")).groupBy("entry").agg(
        *(F.count(F.when((F.col("part") == p) & (F.col("label") == y), 1)).alias(f"n{p}{y}") for p in (0, 1) for y in (0, 1)))
    counts = written(counts.where(f"n01 + n11 >= {MIN_ROWS}"), "entries")
    out = []
    for parts in ((0,), (1,), (0, 1)):
        toxic, other = (sum((F.col(f"n{p}{y}") for p in parts), F.lit(0.0)) for y in (1, 0))
        all_toxic, all_other = (sum(size.get((p, y), 0) for p in parts) for y in (1, 0))
        odds = F.log((toxic + 0.5) / (all_toxic + 1.0)) - F.log((other + 0.5) / (all_other + 1.0))
        low = odds - 1.3 * F.sqrt(1 / (toxic + 0.5) + 1 / (other + 0.5))
        ranked = counts.where(toxic >= MIN_ROWS).select("entry", F.round(low, 9).alias("low"))
        tiers = []
        for lo, hi in ((STRONG, None), (WEAK, STRONG)):
            tier = ranked.where(F.col("low") >= lo) if hi is None else ranked.where((F.col("low") >= lo) & (F.col("low") < hi))
            tiers.append([r["entry"] for r in tier.orderBy(F.desc("low"), "entry").limit(LEXICON).collect()])
        out.append(tuple(tiers))
    discard(counts)
    return out


def _in_lexicon(word: Column, lexicon: list[str]) -> Column:
    """Whether the word or one of its beginnings is an entry."""
    found = word.isin([x for x in lexicon if not x.endswith("*")])
    for k in PREFIXES:
        heads = [x[:-1] for x in lexicon if len(x) == k + 1 and x.endswith("*")]
        if heads:
            found = found | F.substring(word, 1, k).isin(heads)
    return found


def features(text: Column, lexicon: tuple[list[str], list[str]] = ((), ())) -> Column:
    """Array of the ``FEATURES`` of a text, densities per hundred words."""
    t = F.coalesce(text, F.lit(""))
    strong, weak = (list(x) for x in lexicon)

    def learned(w: Column, per: Column) -> list[Column]:
        if not strong and not weak:
            return [F.lit(0.0)] * 5
        near = lambda x, i: F.exists(F.slice(w, F.greatest(i - 5, F.lit(1)), F.lit(12)), lambda y: y.isin(YOU))
        hits = F.filter(F.transform(w, lambda x, i: F.when(_in_lexicon(x, strong), F.struct(x.alias("w"), F.lit(True).alias("s"), near(x, i).alias("y")))
                                    .when(_in_lexicon(x, weak), F.struct(x.alias("w"), F.lit(False).alias("s"), F.lit(False).alias("y")))),
                        lambda h: h.isNotNull())

        def counted(h: Column) -> Column:
            a, b = F.filter(h, lambda x: x["s"]), F.filter(h, lambda x: ~x["s"])
            return F.array(F.size(a) * per, F.size(F.array_distinct(a["w"])).cast("double"), F.size(b) * per,
                           F.size(F.array_distinct(b["w"])).cast("double"), F.size(F.filter(a, lambda x: x["y"])).cast("double"))

        return [let(hits, counted)]

    def on_words(w: Column) -> Column:
        hits = INSULTS + VULGAR + OTHER_LANGUAGES
        plain = F.filter(w, lambda x: x.isin(hits + THREATS))
        per = F.lit(100.0) / F.greatest(F.size(w), F.lit(1))
        near = F.filter(w, lambda x, i: x.isin(hits) & F.exists(F.slice(w, F.greatest(i - 3, F.lit(1)), F.lit(8)),
                                                               lambda y: y.isin(YOU)))
        undone = F.translate(F.lower(t), "01345$@", "oieassa")
        hidden = F.when(undone != F.lower(t), F.size(F.filter(F.split(undone, r"[^\p{L}]+"), lambda x: x.isin(hits)))
                        - F.size(F.filter(plain, lambda x: x.isin(hits)))).otherwise(0)
        more = learned(w, per)
        tail = F.array(*more) if len(more) > 1 else more[0]
        return let(plain, lambda p: F.concat(F.array(
            F.size(F.filter(p, lambda x: x.isin(INSULTS))) * per, F.size(F.filter(p, lambda x: x.isin(VULGAR))) * per,
            F.size(F.filter(p, lambda x: x.isin(THREATS))) * per, F.size(F.filter(p, lambda x: x.isin(OTHER_LANGUAGES))) * per,
            F.size(near) * per, F.greatest(hidden, F.lit(0)) * per, F.size(F.array_distinct(p)).cast("double"),
            F.length(F.regexp_replace(t, r"[^\p{Lu}]+", "")) / F.greatest(F.length(t), F.lit(1)),
            F.regexp_count(t, F.lit(r"\b\p{Lu}{3,}\b")) * per,
            F.length(F.regexp_replace(t, "[^!?]+", "")) * per, F.regexp_count(t, F.lit(r"[!?]{2,}")) * per,
            F.regexp_count(t, F.lit(r"\p{L}[0-9@$*#]+\p{L}")) * per, F.regexp_count(t, F.lit(r"(\p{L})\1{2,}")) * per,
            F.log1p(F.size(w).cast("double"))), tail))

    return let(_words(text), on_words)


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int, trees: int, depth: int):
    """(trees, calibration, lexicon), or the share of label 1 if there is nothing to tell apart.

    ``docs`` has doc_id and text, ``labels`` doc_id and y. Only the labelled rows picked are read on.
    """
    usable = labels.where("doc_id is not null and y is not null").where(~held_out(F.col("doc_id")))
    n = usable.count()
    picked = written(usable.where(sampled(F.col("doc_id"), fit_rows / n)) if n > fit_rows else usable, "picked")
    rows = written(docs.join(picked, "doc_id").select("text", F.col("y").cast("double").alias("label"), fold(F.col("doc_id")).alias("part")), "labelled")
    discard(picked)
    counts = {(r["part"], r["label"]): r["count"] for r in rows.groupBy("part", "label").count().collect()}
    total = sum(counts.values())
    train = [sum(c for (p, y), c in counts.items() if p != 3 and y == k) for k in (0.0, 1.0)]
    if not all(train):
        discard(rows)
        return sum(c for (_, y), c in counts.items() if y == 1.0) / total if total else 0.0
    held = [sum(c for (p, y), c in counts.items() if p == 3 and y == k) for k in (0.0, 1.0)]
    zero, one, both = learn_lexicons(rows)
    made = [rows.where(F.col("part") == p).select("part", "label", features(F.col("text"), lexicon).alias("x"))
            for p, lexicon in ((0, one), (1, zero), (3, both))]
    feats = written(made[0].unionByName(made[1]).unionByName(made[2]), "features")
    vectors = VectorAssembler(inputCols=[f"x{i}" for i in range(len(FEATURES))], outputCol="features").transform(
        feats.select("part", "label", *(F.col("x")[i].alias(f"x{i}") for i in range(len(FEATURES))))).cache()
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, subsamplingRate=0.8, seed=11,
                          minInstancesPerNode=max(1, min(20, min(train) // 4)), cacheNodeIds=False).fit(vectors.where("part <> 3"))
    calibrate = vectors.where("part = 3") if min(held) >= 5 else vectors
    scored = model.transform(calibrate).select(vector_to_array("probability")[1].alias("raw"), "label")
    curve = IsotonicRegression(featuresCol="raw", labelCol="label").fit(scored)
    vectors.unpersist(), discard(rows), discard(feats)
    return model, curve, both


def apply(df: DataFrame, models, text: str, out: str) -> DataFrame:
    """``df`` with the score of the text in column ``text``."""
    if isinstance(models, float):
        return df.withColumn(out, F.lit(models))
    model, curve, lexicon = models
    x = fresh(df, "tox_x")
    cols = [fresh(df, f"feature_{i}_") for i in range(len(FEATURES))]
    made = {k: fresh(df, k) for k in ("tox_features", "tox_raw", "tox_probability", "tox_prediction", "tox_margin")}
    wide = df.withColumn(x, features(F.col(text), lexicon))
    wide = wide.select(*(F.col(f"`{c}`") for c in df.columns), *(F.col(x)[i].alias(c) for i, c in enumerate(cols)))
    wide = VectorAssembler(inputCols=cols, outputCol=made["tox_features"]).transform(wide).drop(*cols)
    model.setFeaturesCol(made["tox_features"]).setProbabilityCol(made["tox_probability"])
    model.setPredictionCol(made["tox_prediction"]).setRawPredictionCol(made["tox_margin"])
    wide = model.transform(wide).withColumn(made["tox_raw"], vector_to_array(made["tox_probability"])[1])
    curve.setFeaturesCol(made["tox_raw"]).setPredictionCol(out)
    return curve.transform(wide).drop(*made.values())


def _known(labels: DataFrame, label: str) -> DataFrame:
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("y"))


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, fit_rows: int = 20_000, trees: int = 30,
                   depth: int = 3, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    scored = apply(rows, fit(rows, _known(labels.withColumnRenamed(doc_id, "doc_id"), label), fit_rows, trees, depth), "text", "score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("score").cast("double").alias("score"),
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, fit_rows: int = 20_000, trees: int = 30,
               depth: int = 3) -> DataFrame:
    """The documents that score below ``threshold``, all columns kept; texts are not shuffled."""
    out = fresh(docs, "tox_score")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    models = fit(rows, _known(labels, "toxic"), fit_rows, trees, depth)
    return apply(docs, models, "text", out).where(F.col(out) < threshold).select(*docs.columns)
