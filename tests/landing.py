"""Small price files for the ingestion tests."""

from pathlib import Path

from tidemill.plans.fuel_prices import SOURCE

HEADER = ";".join(c.name for c in SOURCE.columns)


def price_line(cnpj="12.345.678/0001-90", day="02/01/2025", price="109,99", product="GLP", region="SE", cep="20000-123"):
    return ";".join(
        [region, "RJ", " RIO ", "REVENDA", cnpj, "RUA 1", "10", "", "CENTRO", cep, product, day, price, "", "R$ / 13 kg", "MARCA"]
    )


def price_file(incoming: Path, period: str, name: str, lines, header: str = HEADER) -> Path:
    folder = incoming / SOURCE.name / f"partition={period}"
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
    return path
