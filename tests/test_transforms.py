import numpy as np

from lumenset.functions import transforms


def image(h=60, w=80):
    return np.random.default_rng(0).integers(0, 256, (h, w, 3)).astype(np.uint8)


def test_shapes_and_determinism():
    x = image()
    assert transforms.evaluate(x).shape == (3, 224, 224)
    a, b = (transforms.train(x, transforms.generator("i", 1)) for _ in range(2))
    assert a.shape == (3, 224, 224) and (a == b).all()
    assert (a != transforms.train(x, transforms.generator("i", 2))).any()


def test_normalise_and_rotate():
    x = np.full((4, 4, 3), 255, np.uint8)
    assert np.allclose(transforms.normalise(x)[0], (1 - 0.485) / 0.229)
    y = image(5, 5)
    assert (transforms.rotate(y, 0) == y).all()
    assert (transforms.rotate(transforms.rotate(y, 90), -90) == y).all()
    assert (transforms.center_crop(y, 3, 3) == y[1:4, 1:4]).all()
