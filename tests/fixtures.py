"""Hand-made fixtures (shapes from the landed sources, values invented)."""

from __future__ import annotations

import os

from tests.workbooks import xlsx_bytes


def write_xlsx(path: str, sheets: dict[str, dict[tuple[int, int], tuple]]) -> str:
    """Write a workbook file (cell spec as in ``indicata.plans.landing.xlsx_bytes``)."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(xlsx_bytes(sheets))
    return path


def tax_workbook(path: str) -> str:
    """Crosstab: label column + one column per measure, two header rows with a
    merged gap, a blank row, a formula with a cached value, a wider row, and
    a second sheet."""
    main = {
        (1, 1): ("s", "Delegación"), (1, 2): ("s", "Recaudación"), (1, 4): ("s", "Devoluciones"),
        (2, 1): ("blank", None), (2, 2): ("s", "IRPF"), (2, 3): ("s", "IVA"), (2, 4): ("s", "IRPF"),
        (3, 1): ("s", "Madrid"), (3, 2): ("n", "1500"), (3, 3): ("n", "2500.5"), (3, 4): ("f", ("B3-1000", "500")),
        (4, 1): ("is", "Barcelona"), (4, 2): ("n", "5.0"), (4, 3): ("b", "1"), (4, 4): ("e", "#DIV/0!"),
        (6, 1): ("s", "Atlantis"), (6, 2): ("n", "1E-05"), (6, 3): ("d", "45321.5"), (6, 4): ("fs", ("A6", "x")),
        (6, 5): ("n", "7"),
    }
    other = {(1, 1): ("s", "notes"), (2, 1): ("n", "1")}
    return write_xlsx(path, {"datos_delegaciones": main, "otra": other})


def ipi_csv(path: str) -> str:
    """``;`` text, UTF-8 BOM, CRLF: empty, quoted-empty, NA, null, doubled
    quotes, quoted newline, blank line, short row, long row, repeated
    header, one 501-character value, duplicate header name."""
    long_text = "x" * 501
    lines = [
        "Comunidades y Ciudades Autónomas;Indicador;Periodo;Total;Total",
        'Madrid;"Índice ""general""";2024M01;101,5;NA',
        'Cataluña;"línea\r\nsegunda";2024M02;"";null',
        "",
        "Galicia;corto",
        "Aragón;a;2024M03;1;2;EXTRA",
        "Comunidades y Ciudades Autónomas;Indicador;Periodo;Total;Total",
        f"Murcia;{long_text};2024M04;99,0;",
    ]
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8-sig", newline="") as f:
        f.write("\r\n".join(lines) + "\r\n")
    return path
