"""Column functions: identifiers, partial dates, codings and clinical value rules."""
