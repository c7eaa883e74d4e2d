"""Brute-force references used by the tests: plain Python over the model JSON."""

import json

import numpy as np

from sylva.fixtures import model_text


def doc(model_id):
    return json.loads(model_text(model_id))


def walk(model_id, floats, cats=(), nan_bit=0):
    """Raw scores of one row by walking every tree in plain Python."""
    d = doc(model_id)
    stats = {}
    for st in d.get("target_stats") or []:
        table = {k: (s + st["prior_weight"] * st["prior"]) / (c + st["prior_weight"]) for k, s, c in zip(st["keys"], st["sums"], st["counts"])}
        stats[st["stat_id"]] = (table, st["prior"])
    scale, bias = d["scale_and_bias"]
    k = len(bias)
    total = np.zeros(k)
    for tree in d["oblivious_trees"]:
        leaf = 0
        for lv, s in enumerate(tree["splits"]):
            kind = s.get("split_type", "float")
            if kind == "float":
                x = np.float32(floats[s["float_feature_index"]])
                bit = (not np.isnan(x)) and x > np.float32(s["border"]) if not np.isnan(x) else bool(nan_bit)
            elif kind == "onehot":
                bit = cats[s["cat_feature_index"]] == s["value"]
            else:
                table, prior = stats[s["stat_id"]]
                bit = np.float32(table.get(cats[s["cat_feature_index"]], prior)) > np.float32(s["border"])
            leaf |= int(bit) << lv
        total += np.asarray(tree["leaf_values"][leaf * k : (leaf + 1) * k])
    return scale * total + np.asarray(bias)
