"""Cells of many vectors, compared in blocks."""

import itertools

import numpy as np
import pytest

from inkwell.llm import lattice_dedup


def clusters():
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((4, 16))
    rows = [(i, list(map(float, centres[i % 4] + rng.standard_normal(16) * rng.choice([0.0, 0.05, 0.12]))), int(i % 4 == 3)) for i in range(160)]
    return rows + [(200 + i, rows[i][1], rows[i][2]) for i in range(20)]


@pytest.mark.parametrize("heavy,block", [(64, 512), (0, 4), (3, 2), (12, 1000)])
def test_any_cut_into_blocks_gives_all_links_once(spark, monkeypatch, heavy, block):
    monkeypatch.setattr(lattice_dedup, "HEAVY", heavy)
    monkeypatch.setattr(lattice_dedup, "BLOCK", block)
    rows = clusters()
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in rows}
    label = {i: lab for i, _, lab in rows}
    links = {i: set() for i in unit}
    for a, b in itertools.combinations(unit, 2):
        if label[a] == label[b] and unit[a] @ unit[b] >= 0.98:
            links[a].add(b)
            links[b].add(a)
    root = {i: i for i in links}
    for _ in range(len(links)):
        root = {i: min([root[i], *(root[j] for j in links[i])]) for i in links}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = lattice_dedup.near_duplicate_vectors(df).collect()
    assert {r.id: (r.n_links, r.component) for r in got} == {i: (len(links[i]), root[i]) for i in links} and len(got) == len(rows)
