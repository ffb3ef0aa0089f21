"""Landing files in, layer tables out."""
