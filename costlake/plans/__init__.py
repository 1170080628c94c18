"""Ready flows: raw text to layers, layers to reports, layers to models."""
