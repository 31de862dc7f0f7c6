"""One-hot and morphological vectors, node and edge features.

The category lists fix the slots; one slot more at the end takes any value
that isn't listed, null included.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

POS = tuple("ADJ/ADP/ADV/AUX/CCONJ/DET/INTJ/NOUN/NUM/PART/PRON/PROPN/PUNCT/SCONJ/SYM/VERB/X".split("/"))

_CORE = "nsubj/obj/iobj/csubj/ccomp/xcomp"
_NON_CORE = "obl/vocative/expl/dislocated/advcl/advmod/discourse/aux/cop/mark"
_NOMINAL = "nmod/appos/nummod/acl/amod/det/clf/case"
_OTHER = "conj/cc/fixed/flat/list/parataxis/compound/orphan/goeswith/reparandum/punct/root/dep"
#: (relation, its subtypes) in the order of their slots.
_SUBTYPES = (
    ("acl", "relcl"), ("advcl", "relcl"), ("advmod", "emph/lmod"), ("aux", "pass"), ("case", "gen"), ("cc", "preconj"),
    ("compound", "lvc/prt/redup/svc"), ("csubj", "outer/pass"), ("det", "numgov/nummod/poss"), ("expl", "impers/pass/pv"),
    ("flat", "foreign/name"), ("nmod", "poss/tmod"), ("nummod", "gov"), ("nsubj", "outer/pass"),
    ("obl", "agent/arg/lmod/tmod/npmod"), ("nmod", "npmod"),
)
DEPENDENCIES = tuple("/".join((_CORE, _NON_CORE, _NOMINAL, _OTHER)).split("/")) + tuple(f"{a}:{b}" for a, bs in _SUBTYPES for b in bs.split("/"))
MORPH = tuple("Number/Person/Tense/VerbForm/Case/Gender/Mood/Voice/Aspect".split("/"))
MAPPINGS = {"pos_tags": POS, "dep_types": DEPENDENCIES, "morph_features": MORPH}


def _floats(*values: float) -> Column:
    return F.array(*[F.lit(float(v)).cast("float") for v in values])


def one_hot(value: Column, kind: str, mappings: dict[str, tuple[str, ...]] | None = None) -> Column:
    names = (mappings or MAPPINGS).get(kind)
    if names is None or kind == "morph_features":
        raise ValueError(f"no one-hot list named {kind!r}")
    place = F.array_position(F.array(*map(F.lit, names)), F.coalesce(value, F.lit(""))).cast("int")
    # a constant array of all rows, the one for unlisted values first, so that a value costs one look-up
    n = len(names) + 1
    rows = [[int(j == (i - 1) % n) for j in range(n)] for i in range(n)]
    return F.get(F.from_json(F.lit(json.dumps(rows)), "array<array<float>>"), place)


def morph_vector(morph: Column, names: tuple[str, ...] = MORPH) -> Column:
    """[1, 0] for each feature that the map has and [0, 1] otherwise; all zeros for a null map."""
    has = lambda f: F.when(F.map_contains_key(morph, f), _floats(1, 0)).otherwise(_floats(0, 1))
    return F.when(morph.isNull(), _floats(*[0] * 2 * len(names))).otherwise(F.concat(*[has(f) for f in names]))


def node_features(node: Column, embedding: Column | None = None) -> Column:
    """[word embedding,] part of speech, morphology."""
    own = F.concat(one_hot(node["pos"], "pos_tags"), morph_vector(node["morph"]))
    return own if embedding is None else prepend_embedding(own, embedding)


def edge_features(relation: Column) -> Column:
    return one_hot(relation, "dep_types")


def prepend_embedding(features: Column, embedding: Column) -> Column:
    return F.concat(embedding.cast("array<float>"), features)


def feature_dims(embedding_dim: int = 0) -> dict[str, int]:
    """Widths; ``embedding_dim`` is 0 where embeddings aren't stored."""
    return {"node": embedding_dim + len(POS) + 1 + 2 * len(MORPH), "edge": len(DEPENDENCIES) + 1, "pos": len(POS) + 1, "morph": 2 * len(MORPH)}
