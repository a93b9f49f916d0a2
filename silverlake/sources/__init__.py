"""Bronze objects in, silver tables out and back."""
