"""Hand-made grids with the value expected from each (timeframe 2020)."""

GRIDS = {
    "F1": (["Three months ended March 31,//", "/2020/2019", "Net income per share://", "Basic/$ 0.43/$ 0.40", "Diluted/$ 0.42/$ 0.39"], 0.43),
    "F2": (["Net loss per share, basic and diluted/$/(1.21/)"], -1.21),
    "F3": (["Adjusted EPS/2.71", "Reported EPS/1.84"], 1.84),
    "F4": (["/2019/2020", "Basic EPS/0.40/0.43"], 0.43),
    "F5": (["Earnings per share//", "Basic/0.10/0.20", "Weighted shares/1,000/1,010", "Other/7.5/8.5"], 0.10),
    "F6": (["Basic EPS/0.10", "Basic EPS (loss)/(0.20)"], -0.20),
    "F7": (["Basic EPS/0.10", "Basic EPS/0.30"], 0.10),
    "F8": (["Revenue/10.5"], 0.0),
    "F9": (["Basic EPS/.25"], 0.0),
    "F10": (["Un-adjusted EPS/0.50", "EPS/0.60"], 0.60),
    "F11": (["EPS/0.60", "Internet EPS/0.50"], 0.50),
    "F12": (["Earnings per share/", "/", "Basic items/", "A/0.5"], 0.0),
    "F13": (["Basic EPS/- 0.05"], 0.0),
    "F14": (["Net loss per share/(\u00a00.05)"], -0.05),
    "F14b": (["Net loss per share/(\u20090.05)"], -0.05),
    "F15": (["Q1 2020 EPS of $0.31/0.40"], 0.31),
    "F16": (["Basic EPS/0.05)"], 0.05),
    "F17": (["Basic EPS/1,234.56"], 234.56),
    "F18": (["Diluted non-GAAP EPS/3.10", "Basic non-GAAP EPS/3.20", "Diluted GAAP EPS/2.90"], 2.90),
    "F19": (["Basic EPS/(0.00)"], 0.0),
    "F20": (["Income from operations, shares/0.70"], 0.70),
    "F21": (["E.P.S. basic/0.10"], 0.10),
    "F22": (["e.p.s/0.10"], 0.10),
    # More of the rules above.
    "empty table": (["/", "/"], 0.0),
    "only headers": (["Basic EPS/1"], 0.0),
    "order found late": (["Basic EPS/0.10/0.20", "/2019/2020", "Basic, net EPS/0.40/0.43"], 0.43),
    "years descending": (["/2020/2019", "Basic EPS/0.40/0.43"], 0.40),
    "footnote mark in word": (["EPS²/0.50", "Revenue/1.0"], 0.0),
    "wide digits": (["Basic EPS/０.２５"], 0.25),
    "dash before dollar": (["EPS/-$0.40"], -0.40),
    "dash, dollar, gap": (["EPS/-$ 0.40", "Diluted EPS/0.30"], 0.30),
    "control space": (["Basic EPS/\x1c(\x1d0.07"], -0.07),
    "no-break label": (["\u00a0/Basic EPS/0.15"], 0.15),
}


def grid_rows(grids=GRIDS):
    """Rows (filename, table_seq, row_idx, col_labels, cells); every filing is one table."""
    return [
        (name, 0, i, [], row.split("/"))
        for name, (rows, _) in grids.items()
        for i, row in enumerate(rows)
    ]


GRID_SCHEMA = "filename string, table_seq int, row_idx int, col_labels array<string>, cells array<string>"


def to_html(rows, open_cells=False):
    end = "" if open_cells else "</td>"
    body = "".join(
        "<tr>" + "".join(f"<td>{cell}{end}" for cell in row.split("/")) + "</tr>" for row in rows
    )
    return f"<html><body><p>Results</p><table>{body}</table></body></html>"
