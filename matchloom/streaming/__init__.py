"""The daily landing as a stream."""
