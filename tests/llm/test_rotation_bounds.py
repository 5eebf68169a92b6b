"""Embedding near-dedup on a table with many pairs around its threshold."""

import numpy as np

from tessera.llm import rotation


def around(rng, groups, members, d):
    """Unit vectors whose cosines within a group lie around 0.93."""
    centres = rng.standard_normal((groups, d))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    noise = rng.standard_normal((groups, members, d)) / np.sqrt(d)
    m = centres[:, None, :] + noise * rng.uniform(0.15, 0.4, (groups, members, 1))
    m = m.reshape(-1, d)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def test_every_pair_is_decided_and_few_are_computed(spark):
    rng = np.random.default_rng(4)
    m = around(rng, 60, 12, 64)
    cosine = m @ m.T
    assert (np.abs(cosine[np.triu_indices(len(m), 1)] - 0.93) < 0.02).sum() > 500
    bits, correction = rotation.codes(m)
    estimate, low, high = rotation.bounds(m, bits, correction)
    upper = np.triu_indices(len(m), 1)
    accepted, rejected = (low >= 0.93)[upper], (high < 0.93)[upper]
    assert not (accepted & (cosine[upper] < 0.93)).any() and not (rejected & (cosine[upper] >= 0.93)).any()
    assert abs((estimate - cosine)[upper].mean()) < 0.01  # the estimate has no bias
    recomputed = ~accepted & ~rejected
    print("pairs", len(recomputed), "links", int((cosine[upper] >= 0.93).sum()), "accepted", int(accepted.sum()), "rejected", int(rejected.sum()), "recomputed", int(recomputed.sum()))
    assert recomputed.mean() < 0.05 and rejected.mean() > 0.9
    table = spark.createDataFrame([(i, v, i % 2) for i, v in enumerate(m.tolist())], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in rotation.near_duplicates(table).collect()}
    same = (np.arange(len(m))[:, None] - np.arange(len(m))[None, :]) % 2 == 0
    links = (cosine >= 0.93) & same & ~np.eye(len(m), dtype=bool)
    label = np.arange(len(m))
    while True:
        new = np.minimum(label, np.where(links, label[None, :], len(m)).min(axis=1))
        if (new == label).all():
            break
        label = new
    assert links.sum() > 500
    assert got == {i: (int(links[i].sum()), int(label[i])) for i in range(len(m))}
