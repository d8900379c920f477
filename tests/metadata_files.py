"""Write pipeline metadata as JSON files, the way a user keeps them."""

from __future__ import annotations

import json
from pathlib import Path


class MetadataFiles:
    """A metadata folder under construction."""

    def __init__(self, root: Path) -> None:
        self.root = root
        for part in ("process", "source", "dest"):
            (root / part).mkdir(parents=True, exist_ok=True)

    def _save(self, part: str, name: str, records: list[dict]) -> None:
        (self.root / part / f"{name}.json").write_text(json.dumps(records, ensure_ascii=False), encoding="utf-8")

    def source(self, source_id: str, columns: str, widths: tuple[int, ...] = (), **fields) -> None:
        records = []
        for position, column in enumerate(columns.split(", "), 1):
            name, kind = column.split()
            record = {"srcId": source_id, "colName": name, "colType": kind, "isNullable": "True"}
            record |= {"colPos": str(position), "colId": str(position)}
            if widths:
                record["length"] = str(widths[position - 1])
            records.append(record)
        self._save("source", f"src_{source_id}", [{"srcId": source_id, "srcType": "local", **fields}])
        self._save("source", f"srcCols_{source_id}", records)

    def sink(self, sink_id: str, columns: list[dict], **fields) -> None:
        records = [
            {"destId": sink_id, "colId": str(position), "colType": "String", **column}
            for position, column in enumerate(columns, 1)
        ]
        self._save("dest", f"dest_{sink_id}", [{"destId": sink_id, "mode": "overwrite", **fields}])
        self._save("dest", f"destCols_{sink_id}", records)

    def process(self, process_id: str, links: list[tuple[str, int, str, int]], **fields) -> None:
        """``links`` hold source, source column (-1 for a default), sink, sink column."""
        mapping = [
            {"mapId": f"map_{process_id}", "srcId": s, "srcColId": str(sc), "destId": d, "destColId": str(dc)}
            for s, sc, d, dc in links
        ]
        self._process(process_id, mapping, fields)

    def query(self, process_id: str, sources: list[str], sinks: list[str], text: str, **fields) -> None:
        mapping = [{"mapId": f"map_{process_id}", "srcId": sources, "destId": sinks, "query": text}]
        self._process(process_id, mapping, {"queryProvided": "True", **fields})

    def _process(self, process_id: str, mapping: list[dict], fields: dict) -> None:
        record = {"prcId": process_id, "isActive": "True", "mapId": f"map_{process_id}", **fields}
        self._save("process", f"prc_{process_id}", [record])
        self._save("process", f"colMapping_map_{process_id}", mapping)
