"""Tree regressors: assembly, parameter grids, fitting, scoring."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from itertools import combinations, product
from math import prod
from random import Random

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from hourloom.operators.clean import conform_features
from hourloom.operators.scaling import scale, unscale

SEED = 42
SCALED = "_scaled"
# Split points of a feature. Spark takes them from a sample of the rows where a feature has more values.
BINS = 32

# The axes of the forest search and of the boosted search.
FOREST_AXES = {
    "n_estimators": [200, 300, 400],
    "max_depth": [20, 30, 40],
    "min_samples_split": [2, 5, 10],
    "min_samples_leaf": [2, 4, 8],
    "bootstrap": [True, False],
    "max_features": ["auto", "sqrt", 0.5],
    "max_samples": [None, 0.7],
    "min_weight_fraction_leaf": [0.0, 0.01],
    "oob_score": [False, True],
    "ccp_alpha": [0.0, 0.01],
    "criterion": ["squared_error", "absolute_error"],
}
BOOSTED_AXES = {
    "n_estimators": [100, 300],
    "max_depth": [10, 12],
    "eta": [0.01, 0.02],
    "subsample": [0.8, 1.0],
    "colsample_bytree": [0.3, 0.7],
    "gamma": [0.0, 0.1],
    "min_child_weight": [1, 3],
    "lambda": [1.0, 1.5],
    "alpha": [0.5, 1.0],
    "tree_method": ["approx", "hist"],
    "grow_policy": ["depthwise", "lossguide"],
    "eval_metric": ["rmse", "mae"],
}
AXES = {"RF": FOREST_AXES, "GBT": BOOSTED_AXES}

# Axes that Spark's trees have no setting for; searching them would repeat equal fits.
WITHOUT_COUNTERPART = {
    "RF": ("min_samples_split", "oob_score", "ccp_alpha", "criterion"),
    "GBT": ("lambda", "alpha", "tree_method", "grow_policy", "eval_metric"),
}


def spark_axes(family: str) -> dict[str, list]:
    """The axes that Spark's trees have a setting for.

    Spark's trees end at depth 30; a deeper value stays on its axis, and its trials are logged as errors.
    """
    return {k: v for k, v in AXES[family].items() if k not in WITHOUT_COUNTERPART[family]}


def expand_grid(axes: Mapping[str, Sequence]) -> list[dict]:
    """All valid parameter maps, in the order of the axes."""
    names = list(axes)
    maps = (dict(zip(names, values, strict=True)) for values in product(*axes.values()))
    return list(filter(is_valid, maps))


def _at(axes: Mapping[str, Sequence], number: int) -> dict:
    """The map of a number in the mixed radix of the axes: the product is never listed."""
    out = {}
    for name in reversed(axes):
        number, place = divmod(number, len(axes[name]))
        out[name] = axes[name][place]
    return {name: out[name] for name in axes}


def _completed(axes: Mapping[str, Sequence], fixed: Mapping, wanted: Callable[[dict, str], list], draw: Random) -> dict | None:
    """A valid map that holds ``fixed``, each other axis by the values that ``wanted`` puts first; none if there is none."""
    open_axes = [name for name in axes if name not in fixed]
    draw.shuffle(open_axes)

    def fill(params: dict, rest: list[str]) -> dict | None:
        if not is_valid(params):  # settings that contradict each other stay so, whatever the others are
            return None
        if not rest:
            return {name: params[name] for name in axes}
        for value in wanted(params, rest[0]):
            found = fill({**params, rest[0]: value}, rest[1:])
            if found is not None:
                return found
        return None

    return fill(dict(fixed), open_axes)


def sample_grid(axes: Mapping[str, Sequence], count: int, seed: int = SEED) -> list[dict]:
    """``count`` different valid maps, drawn with a seed, in which every value of every axis occurs.

    More maps are taken if ``count`` is too few to hold all values, fewer if
    there are no more. Maps are drawn by their number in the product.
    """
    draw = Random(seed)
    out: list[dict] = []

    def shuffled(params: dict, name: str) -> list:
        unused = [v for v in axes[name] if not any(m[name] == v for m in out)]
        draw.shuffle(unused)
        used = [v for v in axes[name] if v not in unused]
        return unused + draw.sample(used, len(used))

    for name, values in axes.items():
        for value in values:
            if not any(m[name] == value for m in out) and (found := _completed(axes, {name: value}, shuffled, draw)):
                out.append(found)
    size, seen = prod(map(len, axes.values())), set()
    while len(out) < count and len(seen) < size:
        # While few numbers have been seen, most draws are new; near the end, the rest is drawn from a list of what is left.
        left = None if len(seen) < size // 2 else [n for n in range(size) if n not in seen]
        for number in [draw.randrange(size)] if left is None else draw.sample(left, len(left)):
            if number not in seen and len(out) < count:
                seen.add(number)
                params = _at(axes, number)
                if is_valid(params) and params not in out:
                    out.append(params)
    return out


def covering_grid(axes: Mapping[str, Sequence], seed: int = SEED) -> list[dict]:
    """Few valid maps in which every pair of values of any two axes occurs that can occur in a valid map.

    Each map starts from a pair that is still open and takes, axis by axis, the
    value that closes most open pairs with those already in it. Only pairs are
    listed, never the product of the axes.
    """
    draw = Random(seed)
    places = {name: range(len(values)) for name, values in axes.items()}
    open_pairs = {
        ((a, i), (b, j)) for a, b in combinations(axes, 2) for i in places[a] for j in places[b]
    }
    order = {name: n for n, name in enumerate(axes)}

    def pair(a: tuple[str, int], b: tuple[str, int]) -> tuple:
        return (a, b) if order[a[0]] < order[b[0]] else (b, a)

    def place(name: str, value) -> int:
        return next(i for i in places[name] if axes[name][i] is value or axes[name][i] == value)

    def best_first(params: dict, name: str) -> list:
        chosen = [(n, place(n, v)) for n, v in params.items()]
        gains = [(sum(pair((name, i), c) in open_pairs for c in chosen), draw.random(), i) for i in places[name]]
        return [axes[name][i] for _, _, i in sorted(gains, reverse=True)]

    out = []
    while open_pairs:
        candidates = []
        for first, second in draw.sample(sorted(open_pairs), min(len(open_pairs), 8)):
            fixed = {n: axes[n][i] for n, i in (first, second)}
            found = _completed(axes, fixed, best_first, draw)
            if found is None:
                open_pairs.discard((first, second))  # no valid map holds both
                continue
            held = [(n, place(n, v)) for n, v in found.items()]
            closed = {pair(a, b) for a, b in combinations(held, 2)} & open_pairs
            candidates.append((len(closed), found, closed))
        if candidates:
            _, found, closed = max(candidates, key=lambda c: c[0])
            out.append(found)
            open_pairs -= closed
    return out


def is_valid(params: Mapping) -> bool:
    """Without bootstrap there is no row sample to size and no out-of-bag score."""
    samples_rows = params.get("max_samples") is not None or params.get("oob_score", False)
    return params.get("bootstrap", True) or not samples_rows


def _feature_share(value) -> str:
    return "all" if value == "auto" else str(value)


def forest(params: Mapping, features: str = "features", label: str = "label") -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol=features,
        labelCol=label,
        seed=SEED,
        numTrees=params.get("n_estimators", 100),
        maxDepth=params.get("max_depth", 5),
        minInstancesPerNode=params.get("min_samples_leaf", 1),
        featureSubsetStrategy=_feature_share(params.get("max_features", "auto")),
        subsamplingRate=params.get("max_samples") or 1.0,
        minWeightFractionPerNode=params.get("min_weight_fraction_leaf", 0.0),
        bootstrap=params.get("bootstrap", True),
        maxBins=params.get("max_bins", BINS),
    )


def boosted(
    params: Mapping, features: str = "features", label: str = "label", validation: str | None = None
) -> GBTRegressor:
    """``validation`` names a boolean column: boosting ends when those rows get no better."""
    return GBTRegressor(
        featuresCol=features,
        labelCol=label,
        seed=SEED,
        maxIter=params.get("n_estimators", 20),
        maxDepth=params.get("max_depth", 5),
        stepSize=params.get("eta", 0.1),
        subsamplingRate=params.get("subsample", 1.0),
        featureSubsetStrategy=_feature_share(params.get("colsample_bytree", "auto")),
        minInfoGain=params.get("gamma", 0.0),
        minInstancesPerNode=params.get("min_child_weight", 1),
        maxBins=params.get("max_bins", BINS),
        **({"validationIndicatorCol": validation} if validation else {}),
    )


FAMILIES = {"RF": forest, "GBT": boosted}


def model_pipeline(
    family: str, params: Mapping, features: Sequence[str], label: str, validation: str | None = None
) -> Pipeline:
    """Assemble the scaled features in their recorded order, then the regressor on the scaled label.

    ``validation`` marks rows that stop a boosted fit; a forest takes all rows.
    """
    assembler = VectorAssembler(inputCols=[c + SCALED for c in features], outputCol="features")
    watched = {"validation": validation} if validation and family == "GBT" else {}
    return Pipeline(stages=[assembler, FAMILIES[family](params, label=label + SCALED, **watched)])


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def scale_for_model(
    df: DataFrame,
    params: DataFrame | None,
    features: Sequence[str],
    label: str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Scaled copies of the features and, if given, of the label; without parameters plain copies."""
    columns = [*features, *([label] if label else [])]
    if params is None:
        return df.withColumns({c + SCALED: F.col(f"`{c}`").cast("double") for c in columns})
    return scale(df, params, columns, by, suffix=SCALED)


def predict(
    scaled: DataFrame,
    model: PipelineModel,
    params: DataFrame | None,
    label: str,
    by: Sequence[str] = (),
) -> DataFrame:
    """Predictions in the units of the label, in ``y_pred``."""
    scored = model.transform(scaled).drop("features")
    if params is None:
        return scored.withColumnRenamed("prediction", "y_pred")
    return unscale(scored, params, label, {"prediction": "y_pred"}, by).drop("prediction")


def score(
    df: DataFrame,
    model: PipelineModel,
    feature_order: Sequence[str],
    label: str,
    params: DataFrame | None = None,
    carry: Sequence[str] = (),
    by: Sequence[str] = (),
) -> DataFrame:
    """Score a table of raw features: check and order them, scale, predict, undo the scaling."""
    ordered = conform_features(df, feature_order, carry)
    scaled = scale_for_model(ordered, params, feature_order, by=by)
    return predict(scaled, model, params, label, by).drop(*[c + SCALED for c in feature_order])
