"""p-value finishes against exhaustive enumeration and closed forms."""
import itertools
import math

import pytest

from tidewatch.functions.pvalues import chi2_sf, ks_2samp_pvalue, normal_two_sided


def _ks_brute(n1, n2, d):
    total = outside = 0
    for pos in itertools.combinations(range(n1 + n2), n1):
        s = set(pos)
        i = j = 0
        dmax = 0.0
        for k in range(n1 + n2):
            if k in s:
                i += 1
            else:
                j += 1
            dmax = max(dmax, abs(i / n1 - j / n2))
        total += 1
        outside += dmax >= d - 1e-12
    return outside / total


@pytest.mark.parametrize("n1,n2,d", [(5, 5, 0.6), (4, 6, 0.5), (6, 4, 2 / 3), (7, 5, 0.4)])
def test_ks_exact_matches_enumeration(n1, n2, d):
    assert math.isclose(ks_2samp_pvalue(d, n1, n2), _ks_brute(n1, n2, d), rel_tol=1e-9)


def test_chi2_two_dof_closed_form():
    for x in (0.1, 1.0, 5.0, 12.0):
        assert math.isclose(chi2_sf(x, 2), math.exp(-x / 2), rel_tol=1e-12)


def test_chi2_one_dof():
    assert math.isclose(chi2_sf(3.841458820694124, 1), 0.05, rel_tol=1e-9)


def test_normal_two_sided():
    assert math.isclose(normal_two_sided(1.959963984540054), 0.05, rel_tol=1e-9)
    assert normal_two_sided(0.0) == 1.0


def test_ks_tail_at_every_size():
    """One step of the ECDF is no drift however long the samples are, the two
    forms of Kolmogorov's tail meet, and exact and asymptotic values agree."""
    from tidewatch.functions.pvalues import _kolmogorov_sf
    for n in (20_000, 100_000, 1_000_000, 10 ** 9):
        assert ks_2samp_pvalue(1 / n, n, n) == pytest.approx(1.0, abs=1e-12)
    assert _kolmogorov_sf(1 - 1e-12) == pytest.approx(_kolmogorov_sf(1 + 1e-12), abs=1e-10)
    for z, p in ((0.5, 0.9639452436648751), (1.0, 0.26999967167735456), (1.5, 0.022217962616525127)):
        assert _kolmogorov_sf(z) == pytest.approx(p, rel=1e-9)
    for d in (0.02, 0.03, 0.05):
        exact, limit = (ks_2samp_pvalue(d, 3000, 3000, m) for m in ("exact", "asymptotic"))
        assert exact == pytest.approx(limit, abs=0.02)
    with pytest.raises(ValueError):
        ks_2samp_pvalue(0.1, 5, 5, "other")
