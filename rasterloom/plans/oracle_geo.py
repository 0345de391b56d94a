"""The projections as SQL for the oracle: UTM metres to polar stereographic metres, in named steps."""

A = 6378137.0
F_INV = 298.257223563


def utm_to_polar(source, keep):
    """``source`` is a query with columns x, y, zone and those in ``keep``; yields keep, px_x, px_y."""
    kept = ", ".join(keep)
    return f"""
    SELECT {kept}, rho * sin(radians(lon + 45)) AS px_x, -rho * cos(radians(lon + 45)) AS px_y
    FROM (SELECT {kept}, lon, {A} * mc * tan(pi() / 4 - phi / 2) / pow((1 - e * sin(phi)) / (1 + e * sin(phi)), e / 2) / tc AS rho
    FROM (SELECT {kept}, e, lon, phi, cos(radians(70)) / sqrt(1 - e * e * pow(sin(radians(70)), 2)) AS mc,
                 tan(pi() / 4 - radians(70) / 2) / pow((1 - e * sin(radians(70))) / (1 + e * sin(radians(70))), e / 2) AS tc
    FROM (SELECT {kept}, e, zone * 6 - 183 + degrees(atan2(sinh(q), cos(p))) AS lon,
                 chi + (2*n - 2*n*n/3 - 2*pow(n,3)) * sin(2*chi) + (7*n*n/3 - 8*pow(n,3)/5) * sin(4*chi)
                 + 56*pow(n,3)/15 * sin(6*chi) AS phi
    FROM (SELECT *, asin(sin(p) / cosh(q)) AS chi
    FROM (SELECT *, xi - b1*sin(2*xi)*cosh(2*eta) - b2*sin(4*xi)*cosh(4*eta) - b3*sin(6*xi)*cosh(6*eta) AS p,
                 eta - b1*cos(2*xi)*sinh(2*eta) - b2*cos(4*xi)*sinh(4*eta) - b3*cos(6*xi)*sinh(6*eta) AS q
    FROM (SELECT *, y / (0.9996 * r) AS xi, (x - 500000) / (0.9996 * r) AS eta, n/2 - 2*n*n/3 + 37*pow(n,3)/96 AS b1,
                 n*n/48 + pow(n,3)/15 AS b2, 17*pow(n,3)/480 AS b3
    FROM (SELECT *, {A} / (1 + n) * (1 + n*n/4 + pow(n,4)/64) AS r
    FROM (SELECT *, sqrt(f * (2 - f)) AS e, f / (2 - f) AS n
    FROM (SELECT *, 1 / {F_INV} :: DOUBLE AS f FROM ({source}))))))))))"""


def polar_to_utm(source, keep):
    """``source`` is a query with columns px, py, zone and those in ``keep``; yields keep, x, y."""
    kept = ", ".join(keep)
    return f"""
    SELECT {kept}, 500000 + 0.9996 * r * (eta + a1*cos(2*xi)*sinh(2*eta) + a2*cos(4*xi)*sinh(4*eta) + a3*cos(6*xi)*sinh(6*eta)) AS x,
           0.9996 * r * (xi + a1*sin(2*xi)*cosh(2*eta) + a2*sin(4*xi)*cosh(4*eta) + a3*sin(6*xi)*cosh(6*eta)) AS y
    FROM (SELECT *, atan2(t, cos(dl)) AS xi, atanh(sin(dl) / sqrt(1 + t*t)) AS eta,
                 n/2 - 2*n*n/3 + 5*pow(n,3)/16 AS a1, 13*n*n/48 - 3*pow(n,3)/5 AS a2, 61*pow(n,3)/240 AS a3
    FROM (SELECT *, radians(lon - (zone * 6 - 183)) AS dl, sinh(atanh(sin(phi)) - k * atanh(k * sin(phi))) AS t
    FROM (SELECT *, 2 * sqrt(n) / (1 + n) AS k, {A} / (1 + n) * (1 + n*n/4 + pow(n,4)/64) AS r,
                 chi + (e2/2 + 5*pow(e2,2)/24 + pow(e2,3)/12 + 13*pow(e2,4)/360) * sin(2*chi)
                 + (7*pow(e2,2)/48 + 29*pow(e2,3)/240 + 811*pow(e2,4)/11520) * sin(4*chi)
                 + (7*pow(e2,3)/120 + 81*pow(e2,4)/1120) * sin(6*chi) + 4279*pow(e2,4)/161280 * sin(8*chi) AS phi
    FROM (SELECT *, pi()/2 - 2 * atan(sqrt(px*px + py*py) * tc / ({A} * mc)) AS chi, -45 + degrees(atan2(px, -py)) AS lon
    FROM (SELECT *, cos(radians(70)) / sqrt(1 - e2 * pow(sin(radians(70)), 2)) AS mc,
                 tan(pi() / 4 - radians(70) / 2) / pow((1 - e * sin(radians(70))) / (1 + e * sin(radians(70))), e / 2) AS tc
    FROM (SELECT *, sqrt(f * (2 - f)) AS e, f * (2 - f) AS e2, f / (2 - f) AS n
    FROM (SELECT *, 1 / {F_INV} :: DOUBLE AS f FROM ({source}))))))))"""


def lonlat_to_polar(source, keep):
    """``source`` is a query with columns lon, lat and those in ``keep``; yields keep, px_x, px_y."""
    kept = ", ".join(keep)
    return f"""
    SELECT {kept}, rho * sin(radians(lon + 45)) AS px_x, -rho * cos(radians(lon + 45)) AS px_y
    FROM (SELECT {kept}, lon, {A} * cos(radians(70)) / sqrt(1 - e * e * pow(sin(radians(70)), 2))
              / (tan(pi() / 4 - radians(70) / 2) / pow((1 - e * sin(radians(70))) / (1 + e * sin(radians(70))), e / 2))
              * tan(pi() / 4 - radians(lat) / 2) / pow((1 - e * sin(radians(lat))) / (1 + e * sin(radians(lat))), e / 2) AS rho
    FROM (SELECT *, sqrt(f * (2 - f)) AS e FROM (SELECT *, 1 / {F_INV} :: DOUBLE AS f FROM ({source}))))"""
