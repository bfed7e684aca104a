from tierlake.sources.readers import read_as_text, text_columns
from tierlake.sources.staging import Staging
from tierlake.sources.store import LayerStore

__all__ = ["LayerStore", "Staging", "read_as_text", "text_columns"]
