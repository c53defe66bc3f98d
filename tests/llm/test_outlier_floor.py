"""The floor of the outlier estimates bounds a variance from below; it adds nothing to a larger one."""

from __future__ import annotations

import pytest

from skuflow.llm import outliers


def test_floor_is_a_lower_bound(spark):
    names = [f"c{i}{j}" for i in range(1, 5) for j in range(1, i + 1)]
    values = {"c11": 0.5, "c22": 0.25, "c33": 0.001, "c44": 0.0}
    row = outliers._with_factor(spark.createDataFrame([tuple(values.get(c, 0.0) for c in names)], ", ".join(f"{c} double" for c in names))).first()
    assert [row[f"l{i}{i}"] ** 2 for i in range(1, 5)] == pytest.approx([0.5, 0.25, outliers.FLOOR, outliers.FLOOR])
