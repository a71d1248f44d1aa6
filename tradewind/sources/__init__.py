"""Raw files in, tables out."""
