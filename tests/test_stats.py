"""Numeric helpers used in pandas UDFs (no Spark needed)."""
import math

import pytest

from retention_engine.functions.stats import beta_ppf, betainc, normal_sf_two_sided, t_sf_two_sided


def test_betainc_symmetry_and_uniform():
    assert betainc(1, 1, 0.3) == pytest.approx(0.3, abs=1e-12)
    assert betainc(2.5, 4.0, 0.4) + betainc(4.0, 2.5, 0.6) == pytest.approx(1.0, abs=1e-12)


def test_beta_ppf_inverts():
    x = beta_ppf(0.975, 6, 18)
    assert betainc(6, 18, x) == pytest.approx(0.975, abs=1e-10)


def test_t_and_normal_tails():
    assert t_sf_two_sided(2.0, 10) == pytest.approx(0.0734, abs=1e-4)
    assert normal_sf_two_sided(1.959964) == pytest.approx(0.05, abs=1e-6)
    assert math.isnan(t_sf_two_sided(float("nan"), 4))
