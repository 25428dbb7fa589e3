"""What several test modules share."""

SF = "/root/testdata/sf0.001"


def plain(value):
    if value is None or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, bool) or not isinstance(value, (int, float)) and type(value).__name__ != "Decimal":
        return str(value)
    return f"{float(value):.9g}"


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted([tuple(plain(r[k]) for k in order) for r in rows], key=str)
