"""Which tables and fields look alike, from column profiles (metadata, not data rows)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def matching_ratio(a: Column, b: Column) -> Column:
    """2 x (characters in matching blocks) / (length of both): the longest common run, then the same left and right of it.

    Of equally long runs the one that starts first in `a`, then in `b`, counts.  Column expressions only:
    an aggregate over a stack of open stretches, as many steps as there can be stretches.
    """
    def run(i: Column, j: Column, s: Column) -> Column:
        upto = F.sequence(F.lit(1), F.least(s["ah"] - i, s["bh"] - j))
        return F.size(F.filter(upto, lambda n: F.substr(a, i + 1, n) == F.substr(b, j + 1, n)))

    def longest(s: Column) -> Column:
        places = F.transform(
            F.sequence(s["al"], s["ah"] - 1),
            lambda i: F.array_max(F.transform(F.sequence(s["bl"], s["bh"] - 1), lambda j: F.struct(run(i, j, s).alias("n"), (-i).alias("i"), (-j).alias("j")))),
        )
        return F.array_max(places)

    def stretch(al: Column, ah: Column, bl: Column, bh: Column) -> Column:
        return F.struct(al.alias("al"), ah.alias("ah"), bl.alias("bl"), bh.alias("bh"))

    def step(state: Column, _: Column) -> Column:
        s = F.element_at(state["open"], -1)
        # The run found is bound once, as an array of one, and read from there.
        found = F.transform(F.array(longest(s)), lambda m: F.struct(
            (state["same"] + m["n"]).alias("same"),
            F.concat(
                F.slice(state["open"], F.lit(1), F.size(state["open"]) - 1),
                F.when(m["n"] > 0, F.filter(
                    F.array(stretch(s["al"], -m["i"], s["bl"], -m["j"]), stretch(-m["i"] + m["n"], s["ah"], -m["j"] + m["n"], s["bh"])),
                    lambda x: (x["al"] < x["ah"]) & (x["bl"] < x["bh"]),
                )).otherwise(F.slice(state["open"], 1, 0)),
            ).alias("open"),
        ))
        return F.when(F.size(state["open"]) == 0, state).otherwise(F.get(found, F.lit(0)))

    la, lb = F.length(a), F.length(b)
    whole = F.filter(F.array(stretch(F.lit(0), la, F.lit(0), lb)), lambda x: (x["ah"] > 0) & (x["bh"] > 0))
    start = F.struct(F.lit(0).alias("same"), whole.alias("open"))
    steps = F.sequence(F.lit(1), F.greatest(2 * F.least(la, lb) + 1, F.lit(1)))
    same = F.aggregate(steps, start, step, lambda s: s["same"])
    return F.when(a == b, 1.0).when(la + lb == 0, 1.0).otherwise(2.0 * same / (la + lb))


def name_pairs(names: DataFrame, scope: str, name: str, ratio: float) -> DataFrame:
    """(scope, a, b, similarity), a <= b: pairs of names in a scope whose matching ratio reaches `ratio`, equal names included.

    A similarity join: matching blocks hold at most the characters that both names have, so names need
    ratio / 2 of their characters in common.  Characters, numbered by occurrence, are put in order of
    rarity; names that qualify share one among the first few (prefix filter), and their lengths are near.
    """
    rows = names.select(scope, name).distinct()
    marks = rows.select(scope, name, F.posexplode(F.split(name, "")).alias("i", "c")).where("c <> ''")
    occurrence = F.row_number().over(Window.partitionBy(scope, name, "c").orderBy("i"))
    marks = marks.select(scope, name, F.concat("c", F.lit("#"), occurrence).alias("mark"))
    rarity = marks.groupBy("mark").agg(F.count(F.lit(1)).alias("held"))
    signed = marks.join(rarity, "mark").groupBy(scope, name).agg(F.array_sort(F.collect_list(F.struct("held", "mark"))).alias("marks"))
    signed = materialize(signed.select(scope, name, F.col("marks.mark").alias("marks"), F.size("marks").alias("n")), "name-marks")
    first = (F.col("n") - F.ceil(F.round(F.col("n") * F.lit(ratio / (2 - ratio)), 9)) + 1).cast("int")
    prefix = signed.select(scope, name, "n", F.explode(F.slice("marks", F.lit(1), first)).alias("mark"))
    left, right = (prefix.select(scope, "mark", F.col(name).alias(x), F.col("n").alias(f"n{x}")) for x in "ab")
    near = F.least("na", "nb") * (2 - ratio) >= F.greatest("na", "nb") * ratio - 1e-9
    met = left.join(right, [scope, "mark"]).where(near & (F.col("a") < F.col("b"))).select(scope, "a", "b").distinct()
    sides = [signed.select(scope, F.col(name).alias(x), F.col("marks").alias(f"m{x}")) for x in "ab"]
    met = met.join(sides[0], [scope, "a"]).join(sides[1], [scope, "b"])
    common = 2 * F.size(F.array_intersect("ma", "mb")) >= ratio * (F.size("ma") + F.size("mb")) - 1e-9
    # Spread anew, since matching blocks are the dear part and candidates are few rows.
    scored = met.where(common).select(scope, "a", "b").repartition(scope, "a", "b").withColumn("similarity", matching_ratio(F.col("a"), F.col("b")))
    same = rows.select(scope, F.col(name).alias("a"), F.col(name).alias("b"), F.lit(1.0).alias("similarity"))
    return scored.where(F.col("similarity") >= ratio - 1e-9).unionByName(same)


def table_similarity(fields: DataFrame) -> DataFrame:
    """Weighted Jaccard of fields, roles and metrics for tables sharing any of them.

    Overlaps are counted by joining on the shared item; unions follow from set sizes.
    """
    items = fields.select("arquivo_relativo", F.lit("campo").alias("kind"), F.col("campo_canonico").alias("item"))
    items = items.unionByName(fields.select("arquivo_relativo", F.lit("role").alias("kind"), F.col("role_sugerido").alias("item")))
    items = items.unionByName(
        fields.filter("usar_como_metrica").select("arquivo_relativo", F.lit("metrica").alias("kind"), F.col("campo_canonico").alias("item"))
    ).distinct()
    sizes = items.groupBy("arquivo_relativo").pivot("kind", ["campo", "role", "metrica"]).count().fillna(0)
    left = items.withColumnRenamed("arquivo_relativo", "arquivo_1")
    right = items.withColumnRenamed("arquivo_relativo", "arquivo_2")
    shared = left.join(right, ["kind", "item"]).filter("arquivo_1 < arquivo_2")
    common = shared.groupBy("arquivo_1", "arquivo_2").pivot("kind", ["campo", "role", "metrica"]).count().fillna(0)
    for side in ("1", "2"):
        names = {c: f"{c}_{side}" for c in ("campo", "role", "metrica")}
        common = common.join(sizes.withColumnsRenamed({"arquivo_relativo": f"arquivo_{side}", **names}), f"arquivo_{side}")

    def jaccard(kind: str) -> Column:
        union = F.col(f"{kind}_1") + F.col(f"{kind}_2") - F.col(kind)
        return F.col(kind) / F.greatest(union, F.lit(1))

    score = 0.55 * jaccard("campo") + 0.25 * jaccard("role") + 0.20 * jaccard("metrica")
    return common.select(
        "arquivo_1", "arquivo_2", score.alias("score_similaridade"), F.col("campo").alias("campos_em_comum"),
        F.col("role").alias("roles_em_comum"), F.col("metrica").alias("metricas_em_comum"),
    )


def field_similarity(fields: DataFrame, threshold: float = 0.80) -> DataFrame:
    """Pairs of columns whose name, role and type agree.

    The score needs the same role to reach the threshold (name and type alone give at most
    0.75), so an equi-join on the role loses nothing.
    """
    keys = ["arquivo_relativo", "coluna", "campo_canonico", "role_sugerido", "tipo_inferido"]
    rows = fields.filter("role_sugerido <> ''").select(*keys).distinct()
    least = max((threshold - 0.35) / 0.65, 0.01)
    half = name_pairs(rows, "role_sugerido", "campo_canonico", least).withColumnRenamed("similarity", "similaridade_nome")
    scored = half.unionByName(half.where("a <> b").select("role_sugerido", F.col("b").alias("a"), F.col("a").alias("b"), "similaridade_nome"))
    left = rows.withColumnsRenamed({"arquivo_relativo": "arquivo_1", "coluna": "campo_1", "campo_canonico": "a", "tipo_inferido": "tipo_1"})
    right = rows.withColumnsRenamed({"arquivo_relativo": "arquivo_2", "coluna": "campo_2", "campo_canonico": "b", "tipo_inferido": "tipo_2"})
    out = left.join(scored, ["role_sugerido", "a"]).join(right, ["role_sugerido", "b"])
    out = out.filter(F.struct("arquivo_1", "campo_1") < F.struct("arquivo_2", "campo_2"))
    same_type = F.col("tipo_1") == F.col("tipo_2")
    score = 0.65 * F.col("similaridade_nome") + 0.25 + 0.10 * same_type.cast("int")
    return out.withColumns({"score_similaridade": score, "mesmo_tipo": same_type, "mesmo_role": F.lit(True)}).filter(
        F.col("score_similaridade") >= threshold
    ).withColumnsRenamed({"a": "campo_1_canonico", "b": "campo_2_canonico"})


def canonical_field_map(fields: DataFrame, pairs: DataFrame, threshold: float = 0.88) -> DataFrame:
    """Groups of canonical names connected by strong similarity, by spreading the least name.

    Each round is one join; lineage is cut through the shared folder, and rounds end when no
    name changes.
    """
    strong = pairs.filter(F.col("score_similaridade") >= threshold).select(
        F.col("campo_1_canonico").alias("a"), F.col("campo_2_canonico").alias("b")
    ).filter("a <> b")
    edges = materialize(strong.unionByName(strong.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = materialize(fields.select(F.col("campo_canonico").alias("a")).distinct().withColumn("g", F.col("a")), "labels")
    while True:
        heard = edges.join(labels.withColumnsRenamed({"a": "b", "g": "h"}), "b").groupBy("a").agg(F.min("h").alias("h"))
        updated = materialize(labels.join(heard, "a", "left").select("a", F.least("g", "h").alias("new"), "g"), "labels")
        changed = updated.filter("new <> g").limit(1).count()
        labels = updated.select("a", F.col("new").alias("g"))
        if not changed:
            break
    named = fields.join(labels.withColumnsRenamed({"a": "campo_canonico", "g": "grupo_canonico_aprendido"}), "campo_canonico")
    text = lambda c: F.array_join(F.array_sort(F.collect_set(F.nullif(F.col(c), F.lit("")))), ", ")
    return named.groupBy("grupo_canonico_aprendido").agg(
        text("coluna").alias("campos_originais"), F.countDistinct("arquivo_relativo").alias("qtd_arquivos"),
        text("role_sugerido").alias("roles_detectados"), text("tipo_inferido").alias("tipos_detectados"),
    )
