"""All comparison SQL by query name."""

from checks import experiments, facts, files, pages, predictions, showcase, texts

ORACLES: dict[str, str] = {**showcase.ORACLES, **pages.ORACLES, **texts.ORACLES, **experiments.ORACLES, **predictions.ORACLES, **files.ORACLES, **facts.ORACLES}
