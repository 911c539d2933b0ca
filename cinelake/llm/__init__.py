"""Training-data operators over the ``documents``, ``pages``, ``conversations``,
``benchmark`` and ``labels`` tables. Nothing else in the library imports this
package; ``registry`` lists its queries."""
