"""plans."""
